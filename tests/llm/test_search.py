import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lagscope.llm import search

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain(docs, items, best=10):
    """All scores of (key, text) rows for (id, text) items."""
    counts = [(key, Counter(terms_of(text))) for key, text in docs]
    counts = [(key, c, c.total()) for key, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    found = []
    for item, text in set(items):
        scores = []
        for key, c, n in counts:
            m = 10 + (90 * n * n_docs) // n_terms
            score = 0
            for t in set(terms_of(text)):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        found += [(item, i + 1, key, -score) for i, (score, _, _, key) in enumerate(sorted(scores, key=lambda s: s[:3])[:best])]
    return sorted(found, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def run(docs, items, best=10):
    found = search.search(docs, items, best).select("item_id", "rank", "doc_id", "score")
    return sorted((tuple(r) for r in found.collect()), key=repr)


DOCS = [
    (1, "The cat, the CAT and the dog."), (2, "A dog; a log!"), (3, None), (4, ""), (5, "--- ..."), (6, "über Übermut 42x"),
    (7, "cat"), (7, "cat"), (8, "cat " * 50), (None, "dog cat"), (9, "the the the"), (10, "中文 cat 中文"), (11, "ÜBER"),
]
ITEMS = [
    (1, "cat dog"), (2, "The über"), (3, None), (4, "..."), (5, "unheard"), (6, "cat dog"), (6, "中文"), (1, "cat dog"), (None, "log 42X"),
]


@pytest.mark.parametrize("best", [1, 3, 10])
def test_equals_a_plain_version(spark, best):
    assert run(*frames(spark, DOCS, ITEMS), best) == plain(DOCS, [i for i in ITEMS if i[1]], best)


def test_many_documents_and_narrow_filters(spark, monkeypatch):
    """Filters that say yes too often change nothing but the work."""
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(random.choice(words, random.integers(1, 60) ** 2 // 9 + 1))) for i in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(30)]
    items = [(i, " ".join(random.choice(words, 5))) for i in range(12)] + [(99, docs[5][1])]
    expected = plain(docs, items)
    made = frames(spark, docs, items)
    assert run(*made) == expected
    monkeypatch.setattr(search, "BITS", 2)
    monkeypatch.setattr(search, "HASHES", 1)
    monkeypatch.setattr(search, "MOST_DOCS", 24)
    monkeypatch.setattr(search, "SLAB", 7)
    monkeypatch.setattr(search, "PIECE", 3_000)
    monkeypatch.setattr(search, "MOST_BROADCAST", 0)
    assert run(*made) == expected


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "MOST_TERMS", 10)
    assert run(*frames(spark, DOCS, ITEMS)) == plain(DOCS, [i for i in ITEMS if i[1]])


def test_bounds_hold(spark, sf_dir):
    """No document scores more than its bound, and the bounds leave out nearly all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    asked = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").toArrow()
    items = search.Items.of(asked.column("item_id").to_pylist(), asked.column("text"))
    blocks = search.sign_documents(docs, items)
    weights = search.weigh(blocks, items)
    signed = [b for b in blocks.toArrow().to_batches()]
    bound = {}
    for block, keys, _ in search._rows(iter(signed)):
        own = search._bounds(block, items, weights)
        for j, key in enumerate(keys.to_pylist()):
            bound[key] = own[:, j]
    rows = docs.select("doc_id", "text").collect()
    scores = plain([tuple(r) for r in rows], list(zip(items.ids, asked.column("text").to_pylist(), strict=True)), best=10**9)
    place = {item: i for i, item in enumerate(items.ids)}
    assert scores and all(bound[key][place[item]] >= score for item, _, key, score in scores)
    tight = [score / bound[key][place[item]] for item, rank, key, score in scores if rank <= 10]
    assert np.mean(tight) > 0.8


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "the same row words more"), (2, None), (3, "w1x1 w5x5")], "item_id long, text string")
    extra = items.withColumns({"key": F.lit(1), "item": F.lit("x"), "rank": F.lit(2), "block": F.lit(3)})
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert run(odd, extra) == plain(rows, [(1, "the same row words more"), (3, "w1x1 w5x5")])
    assert run(nothing, items) == []
    assert run(odd, items.limit(0)) == []


def test_terms_are_found_by_bytes():
    items = search.Items.of([1, 2], pa.array(["Ab-c 中 ab", "C_9"]))
    assert sorted(items.terms) == sorted([b"ab", b"c", "中".encode(), b"9"])
    assert [sorted(items.terms[t] for t in part) for part in np.split(items.term, items.starts[1:])] == [
        sorted([b"ab", b"c", "中".encode()]), [b"9", b"c"],
    ]
