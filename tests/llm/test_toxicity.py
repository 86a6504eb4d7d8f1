import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagscope.llm import queries, toxicity
from lagscope.llm.tables import held_out


@pytest.mark.parametrize("size", [64, 3, 2, 1])
def test_marginals_are_those_of_all_paths(monkeypatch, size):
    monkeypatch.setattr(toxicity, "BLOCK", size)
    rng = np.random.default_rng(0)
    emission, move = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    first = np.array([0, 4, 4, 9])
    toxic, pairs, log_sum = toxicity.marginals(emission, move, first)
    expected, expected_pairs, expected_sum = np.zeros(9), np.zeros((2, 2)), 0.0
    for a, b in ((0, 4), (4, 9)):
        weights = {}
        for path in itertools.product((0, 1), repeat=b - a):
            s = sum(emission[a + i, y] for i, y in enumerate(path)) + sum(move[x, y] for x, y in itertools.pairwise(path))
            weights[path] = np.exp(s)
        total = sum(weights.values())
        expected_sum += np.log(total)
        for path, w in weights.items():
            expected[a:b] += np.array(path) * w / total
            for x, y in itertools.pairwise(path):
                expected_pairs[x, y] += w / total
    assert np.allclose(toxic, expected)
    assert np.allclose(pairs, expected_pairs)
    assert np.isclose(log_sum, expected_sum)


def test_blocks_hold_every_word_once():
    first = np.array([0, 0, 1, 200, 264])
    starts, sizes, nth = toxicity.blocks(first)
    assert sorted(x for s, n in zip(starts, sizes, strict=True) for x in range(s, s + n)) == list(range(264))
    assert sizes.max() <= toxicity.BLOCK
    assert nth.tolist() == [0, 0, 1, 2, 3, 0]


def test_a_long_text_is_one_chain(monkeypatch):
    """Strong potentials over thousands of words, against one recursion per text in logarithms."""
    rng = np.random.default_rng(1)
    first = np.array([0, 5000, 5000, 5001, 5066, 5130, 9000])
    emission, move = rng.normal(0, 4, size=(9000, 2)), np.array([[3.0, -2.0], [-4.0, 2.0]])
    expected = np.zeros(9000)
    for a, b in zip(first[:-1], first[1:], strict=True):
        ahead, behind = emission[a:b].copy(), np.zeros((b - a, 2))
        for i in range(1, b - a):
            ahead[i] += np.logaddexp(*(ahead[i - 1][:, None] + move))
        for i in range(b - a - 2, -1, -1):
            behind[i] = np.logaddexp(*(move + emission[a + i + 1] + behind[i + 1]).T)
        both = ahead + behind
        expected[a:b] = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    found = [toxicity.marginals(emission, move, first)]
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    found.append(toxicity.marginals(emission, move, first))
    for toxic, _, _ in found:
        assert np.allclose(toxic, expected, atol=1e-9)
    assert np.allclose(found[0][1], found[1][1]) and np.isclose(found[0][2], found[1][2])
    assert np.isclose(found[0][1].sum(), 9000 - 5)


def test_planted_words_are_found_and_placed(spark):
    filler = "the calm river runs by green fields under wide bright skies today".split()
    rows = []
    for i in range(120):
        words = filler[i % 5 :] + filler[: i % 7]
        bad = i % 3 == 0
        if bad:
            words = [*words[:4], "vile", "scoundrel", *words[4:]]
        rows.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(docs, docs.select("doc_id", "toxic"))
    fresh = spark.createDataFrame(
        [(1, "Green fields, VILE scoundrel! Wide skies."), (2, "Green fields and wide skies."), (3, ""), (4, None)],
        "doc_id long, text string",
    )
    found = {r["doc_id"]: r for r in toxicity.score_toxicity(fresh, model).collect()}
    assert [found[i]["predicted"] for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [tuple(s) for s in found[1]["toxic_spans"]] == [(14, 28)]
    assert found[3]["score"] == found[4]["score"] < found[1]["score"]
    assert [r["doc_id"] for r in toxicity.keep_civil(fresh, model).orderBy("doc_id").collect()] == [2, 3, 4]


def test_held_out_accuracy(spark, largest_dir):
    scored = queries.toxicity_field(spark, largest_dir)
    labels = spark.read.parquet(f"{largest_dir}/labels.parquet")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == t] for t in (1, 0))
    above = np.mean([[(a > b) + 0.5 * (a == b) for b in clean] for a in toxic])
    assert above > 0.93
    assert np.mean([s < toxicity.THRESHOLD for s in clean]) > 0.95


def test_labels_of_the_held_out_fold_teach_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = []
    for own in (labels, turned):
        model = toxicity.fit_toxicity(docs, own.filter(~held_out(F.col("doc_id"))))
        scores.append(sorted((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(docs, model).collect()))
    assert scores[0] == scores[1]


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (None, 1), (7, None), (6, 0)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(odd, labels)
    assert toxicity.score_toxicity(odd, model).filter("score between 0 and 1").count() == odd.count()
    assert toxicity.keep_civil(odd, model).columns == odd.columns
    assert toxicity.score_toxicity(nothing, model).count() == 0
    none = toxicity.fit_toxicity(odd, labels.limit(0))
    assert none is None
    assert {r["score"] for r in toxicity.score_toxicity(odd, none).collect()} == {0.0}
    assert toxicity.keep_civil(odd, none).count() == odd.count()
