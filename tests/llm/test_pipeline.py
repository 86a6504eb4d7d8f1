"""Each stage of the pipeline against a plain version of it, on what the stage before kept."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_mixing import plain_targets
from test_near import plain_components, plain_sets

import corpus_pipeline
from lagscope.llm import lexing as lx
from lagscope.llm import mixing, queries, tokens, toxicity
from lagscope.llm.tables import held_out, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        frames.append(docs)
    return frames


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain_score(model, text):
    """Words one by one, states by the sums of the two directions, the logistic last."""
    data = (text or "").lower().encode()
    words = re.findall(rb"[A-Za-z\x80-\xff]+", data)
    chains = [words] if words else []
    marginals = []
    for chain in chains:
        scores = []
        for word in chain:
            hashes = lx.Words(np.frombuffer(word, np.uint8), np.array([0, len(word)]), lx.LETTERS).hashes
            evidence = model["evidence"][int(hashes[0] >> np.uint64(46))]
            scores.append(model["emit"][np.searchsorted(toxicity.STEPS, evidence, "right")])
        forward = [[math.exp(s) for s in scores[0]]]
        for s in scores[1:]:
            now = [math.exp(s[y]) * sum(forward[-1][x] * math.exp(model["move"][x][y]) for x in (0, 1)) for y in (0, 1)]
            forward.append([v / sum(now) for v in now])
        back = [1.0, 1.0]
        own = []
        for i in range(len(chain) - 1, -1, -1):
            both = [forward[i][y] * back[y] for y in (0, 1)]
            own.append(both[1] / sum(both))
            back = [sum(math.exp(model["move"][x][y] + scores[i][y]) * back[y] for y in (0, 1)) for x in (0, 1)]
            back = [v / sum(back) for v in back]
        marginals += own[::-1]
    expected = sum(marginals)
    of_text = [1.0, math.log1p(expected), math.sqrt(expected / max(len(marginals), 1)), max(marginals, default=0.0)]
    return 1 / (1 + math.exp(-max(-30, min(30, float(np.dot(of_text, model["beta"]))))))


def test_the_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near-dedup", "decontamination", "mixing", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_return_the_columns_of_documents(steps):
    assert all(df.columns == COLUMNS for df in steps[:5])


def test_toxic_documents_go(spark, steps, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    model = toxicity.fit_toxicity(steps[0], labels)
    expected = [r for r in rows_of(steps[0]) if plain_score(model, r[1]) < toxicity.THRESHOLD]
    assert rows_of(steps[1]) == expected


def test_one_of_each_group_stays(steps):
    rows = rows_of(steps[1])
    label = plain_components([r[0] for r in rows], plain_sets([r[1] for r in rows], 5), 80)
    assert rows_of(steps[2]) == [r for r, c in zip(rows, label, strict=True) if r[0] == c]


def test_documents_with_a_passage_of_the_benchmark_go(spark, steps, sf_dir):
    def words(text):
        return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "

    items = [words(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = [r for r in rows_of(steps[2]) if not any(i in words(r[1] or "") for i in items)]
    assert rows_of(steps[3]) == expected


def test_the_mix_meets_its_targets(steps):
    before, after = steps[3].collect(), Counter(map(tuple, steps[4].collect()))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, smallest = defaultdict(int), defaultdict(int), {}
    for r in before:
        sizes[r["source"]] += size(r["text"])
        smallest[r["source"]] = min(smallest.get(r["source"], 1 << 30), max(size(r["text"]), 1))
        taken[r["source"]] += after[tuple(r)] * size(r["text"])
        assert after[tuple(r)] <= mixing.MOST_COPIES
    assert set(after) <= {tuple(r) for r in before}
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= max(smallest[source], 0.03 * target)


def test_the_token_files_hold_the_mix(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    expected, at = [], 0
    for r in sorted(steps[4].collect(), key=lambda r: r["doc_id"]):
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, tokens.END_ID]
        expected.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows_of(steps[5]) == sorted(expected, key=repr)


def test_run_applies_them_all(spark, steps, sf_dir):
    assert rows_of(corpus_pipeline.run(spark, sf_dir)) == rows_of(steps[5])


def test_odd_rows(spark, odd, nothing, tmp_path):
    """Every stage on rows with nulls, blanks, repeats and clashing names, and on none."""
    spark.createDataFrame([(4, 1, 1), (5, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([(1, "one key with another text altogether of words that are not")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    for start in (odd, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == odd.columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert last.count() == docs.count()


def test_text_bytes_of_nothing():
    assert lx.text_bytes(pa.array([], pa.string()))[1].tolist() == [0]
