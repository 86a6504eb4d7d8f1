import re
from collections import Counter

import numpy as np

from lagscope.llm import quality, queries


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    inside = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
    )


def check(rows, texts):
    for r in rows:
        counts = plain_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["ratio"] >= quality.LEAST_RATIO)


def test_counts_equal_a_plain_version(spark):
    texts = [
        None, "", "\n\n \n", "a b c d e a b c d e", "one\ntwo\none\n one\none\r\none\n", "é#*中 $%&|<> 😀\n" * 3,
        "x y z " * 20, "a b c d e f g h i j k l m n", "same line\nother\nsame line\n\n\nsame line",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(quality.judge_texts(df, np.zeros(quality.BUCKETS)).collect(), texts)


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.quality_ratio(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_ratio_is_the_mean_over_ngrams(spark):
    docs = spark.createDataFrame(
        [(1, "good words here good words"), (2, "bad junk stuff"), (3, "bad junk words")], "doc_id long, text string"
    )
    trusted = docs.select("doc_id").filter("doc_id = 1")
    ratios = quality.fit_ratios(docs, trusted)
    raw, target = Counter(), Counter()
    grams = {}
    for r in docs.collect():
        w = r["text"].split()
        grams[r["doc_id"]] = w + list(zip(w, w[1:], strict=False))
        raw.update(grams[r["doc_id"]])
        target.update(grams[r["doc_id"]] if r["doc_id"] == 1 else ())
    n, b, p = sum(raw.values()), quality.BUCKETS, quality.PRIOR_WEIGHT

    def ratio(g):
        share = (raw[g] + 1) / (n + b)
        return np.log((target[g] + p * share) / (sum(target.values()) + p) / share)

    for r in quality.judge_texts(docs, ratios).collect():
        own = grams[r["doc_id"]]
        assert np.isclose(r["ratio"], sum(map(ratio, own)) / len(own))


def test_all_trusted_documents_count(spark):
    n = 21_000
    docs = spark.range(n).selectExpr("id AS doc_id", "'same two' AS text")
    ratios = quality.fit_ratios(docs, docs.select("doc_id"))
    p = quality.PRIOR_WEIGHT
    share = (n + 1) / (3 * n + quality.BUCKETS)
    expected = np.log((n + p * share) / (3 * n + p) / share)
    assert np.isclose(ratios.max(), expected, rtol=1e-9)


def test_clean_documents_are_kept_and_junk_goes(spark, larger_dir):
    labels = spark.read.parquet(f"{larger_dir}/labels.parquet")
    rows = queries.quality_ratio(spark, larger_dir).join(labels, "doc_id").filter("not base_failed").collect()
    kept = {q: np.mean([r["kept"] for r in rows if r["quality"] == q]) for q in (0, 1)}
    assert kept[1] > 0.98
    assert kept[0] < 0.4


def test_odd_rows(odd, nothing):
    ratios = quality.fit_ratios(odd, odd.select("doc_id"))
    rows = quality.judge_texts(odd, ratios).collect()
    assert len(rows) == odd.count()
    assert not quality.fit_ratios(odd, odd.select("doc_id").limit(0)).any()
    assert not quality.fit_ratios(nothing, odd.select("doc_id")).any()
    assert quality.judge_texts(nothing, ratios).count() == 0
