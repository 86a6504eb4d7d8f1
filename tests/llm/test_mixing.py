import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagscope.llm import mixing, queries, tables


def plain_targets(sizes):
    """Share by weight, hold at the cap, and share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    cap = {s: mixing.MOST_COPIES * sizes[s] for s in names}
    held, left = {}, dict.fromkeys(names)
    while left:
        rest = sum(sizes.values()) - sum(held.values())
        total = sum(weight[s] for s in left)
        share = {s: rest * weight[s] / total for s in left}
        over = [s for s in left if share[s] > cap[s]]
        if not over:
            return {**held, **share}
        for s in over:
            held[s] = cap[s]
            del left[s]
    return held


def check(rows, docs):
    size_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, smallest = defaultdict(int), defaultdict(int), {}
    for key, text, source in docs:
        sizes[source] += size_of(text)
    targets = plain_targets(sizes)
    source_of = {key: source for key, _, source in docs}
    for r in rows:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source]
        assert np.isclose(r["target"], targets[source])
        assert 0 <= r["taken"] <= mixing.MOST_COPIES * r["size"]
        taken[source] += r["taken"]
        if r["size"]:
            smallest[source] = min(smallest.get(source, r["size"]), r["size"])
    assert sorted(r["size"] for r in rows) == sorted(size_of(t) for _, t, _ in docs)
    for source, target in targets.items():
        # Whole copies miss by at most half the smallest size, unless the large ones cannot.
        assert abs(taken[source] - target) <= max(smallest.get(source, 0), 0.02 * target), source


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 10, "c": 1000, None: 5}, {"a": 1}, {"a": 10, "b": 10, "c": 10, "d": 10}, {"x": 0, "y": 7, "z": 90000},
])
def test_targets_equal_a_plain_version(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    expected = plain_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(np.isclose(found[s], expected[s]) for s in found)


@pytest.fixture(scope="module")
def uneven():
    rng = np.random.default_rng(4)
    rows = []
    for s, n in (("a", 400), ("b", 60), ("c", 30), (None, 12), ("d", 3)):
        sizes = rng.lognormal(3, 1.2, n).astype(int)
        rows += [(len(rows) + i, " ".join(["w"] * int(k)), s) for i, k in enumerate(sizes)]
    return rows


def test_sources_meet_their_targets(spark, uneven):
    df = spark.createDataFrame(uneven, "doc_id long, text string, source string").repartition(5)
    rows = mixing.mix_sources(df).collect()
    check(rows, uneven)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_sources(df.repartition(3)).collect()))


def test_rates_solve_the_dual(spark, uneven):
    df = spark.createDataFrame(uneven, "doc_id long, text string, source string")
    by_source = defaultdict(list)
    for r in mixing.mix_sources(df).join(df.select("doc_id", "source"), "doc_id").collect():
        by_source[r["source"]].append(r)
    for rows in by_source.values():
        target = rows[0]["target"]
        assert np.isclose(sum(r["rate"] * r["size"] for r in rows), target, rtol=1e-6)
        # Below the cap, log rates are in proportion to sizes.
        tilts = {round(np.log(r["rate"]) / r["size"], 9) for r in rows if r["size"] and r["rate"] < 2.999}
        assert len(tilts) <= 1


def test_copies_of_equal_documents_differ_by_one(spark):
    rows = [(i, "w " * 10, "a") for i in range(997)] + [(5000 + i, "w " * 10, "b") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(df).collect()
    check(found, rows)
    for a, b in ((0, 5000), (5000, 9999)):
        copies = {r["copies"] for r in found if a <= r["doc_id"] < b}
        assert max(copies) - min(copies) <= 1


def test_the_mix_repeats_rows(spark, uneven):
    df = spark.createDataFrame(uneven, "doc_id long, text string, source string")
    mix = {r["doc_id"]: r["count"] for r in mixing.take_copies(df).groupBy("doc_id").count().collect()}
    assert mix == {r["doc_id"]: r["copies"] for r in mixing.mix_sources(df).filter("copies > 0").collect()}


def test_odd_rows(odd, nothing):
    rows = mixing.mix_sources(odd)
    assert rows.count() == odd.count()
    assert rows.filter("size = 0 and taken <> 0").count() == 0
    taken = mixing.take_copies(odd)
    assert taken.columns == odd.columns
    words = taken.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert words == rows.agg(F.sum("taken")).first()[0]
    assert mixing.mix_sources(nothing).count() == mixing.take_copies(nothing).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    check(queries.mixing_entropy(spark, sf_dir).collect(), [tuple(r) for r in docs])


def test_a_source_that_cannot_be_as_close_as_asked_still_ends(spark, monkeypatch):
    """No sum meets a target of thirds: the bracket closes, at the nearest number there is."""
    monkeypatch.setattr(mixing, "CLOSE", 0.0)
    monkeypatch.setattr(mixing, "PATIENCE", 0)
    sizes = spark.createDataFrame([(0, 3, 5), (0, 7, 2), (1, 4, 6)], "sid long, size long, n long")
    sources = spark.createDataFrame(
        [(0, 4.0, 29 / 3, 87.0), (1, 4.0, 100 / 3, 72.0)], "sid long, mean_size double, target double, cap double"
    )
    tilts = {r["sid"]: r["tilt"] for r in mixing.solve_tilts(sizes, sources).collect()}
    taken = 15 * np.exp(tilts[0] * 3 / 4) + 14 * np.exp(tilts[0] * 7 / 4), 24 * np.exp(tilts[1])
    assert np.allclose(taken, (29 / 3, 100 / 3), atol=1e-5)


def test_the_driver_plans_small_steps(spark, uneven, monkeypatch):
    """Sizes are counted once and not in every Newton step, and the mix reads dealt copies: the
    driver holds small plans at any time."""
    plans = []

    def kept(df, purpose):
        plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return tables.stored(df, purpose)

    monkeypatch.setattr(mixing, "stored", kept)
    df = spark.createDataFrame(uneven, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(df)
    steps = [plan for purpose, plan in plans if purpose == "tilts"][1:]
    assert len(steps) > 1
    assert all(plan.count("Exchange hashpartitioning") == 1 for plan in steps)
    assert "Generate" not in mixed._jdf.queryExecution().executedPlan().toString()
    check(mixed.collect(), uneven)
