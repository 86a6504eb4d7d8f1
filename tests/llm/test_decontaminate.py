import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from lagscope.llm import decontaminate, queries
from lagscope.llm import lexing as lx


@pytest.fixture(scope="module")
def words():
    rng = random.Random(11)
    return ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(3000)]


def prose(words, n, seed):
    return random.Random(seed).choices(words, k=n)


def pairs(df):
    return {(r["doc_id"], r["item_id"]): r for r in df.collect()}


def test_passages_with_replaced_words_are_found(spark, words):
    items = [(i, " ".join(prose(words, 40, i)).capitalize() + ".") for i in range(30)]
    docs, expected = [], set()
    for i, (item, text) in enumerate(items):
        own = text.lower().rstrip(".").split()
        for j in random.Random(i).sample(range(40), i % 5):
            own[j] = f"other{j}"
        body = prose(words, 60, 100 + i)
        cut = own[:40] if i % 3 else own[5:35]
        docs.append((i, " ".join([*body[:30], *cut, *body[30:]]).upper().replace(" ", ", ", 3)))
        expected.add((i, item))
    docs += [(1000 + i, " ".join(prose(words, 120, 900 + i))) for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = pairs(decontaminate.find_contamination(d, b))
    assert set(found) == expected
    row = found[(1, 1)]
    assert (row["doc_start"], row["item_start"], row["span"]) == (30, 0, 40)
    assert row["matched"] == 39
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(d, b).collect()} == {i for i, _ in docs if i >= 1000}


def test_hits_equal_a_plain_alignment(spark, words):
    """All lines of all items against all documents."""
    items = [(i, " ".join(prose(words, 25, i))) for i in range(12)]
    docs = []
    for i in range(40):
        a, b = prose(words, 50, 500 + i), items[i % 12][1].split()
        n = 8 + i % 18
        docs.append((i, " ".join([*a[:20], *b[:n], *a[20:]])))
    expected = set()
    for doc, text in docs:
        t = text.split()
        for item, own in items:
            w = own.split()
            for shift in range(-len(w) + 1, len(t)):
                lo, hi = max(0, -shift), min(len(w), len(t) - shift)
                same = [t[shift + k] == w[k] for k in range(lo, hi)]
                best = max(
                    ((sum(1 if s else decontaminate.MISMATCH for s in same[x:y]), y - x, sum(same[x:y]))
                     for x in range(len(same)) for y in range(x + 1, len(same) + 1)), default=(0, 0, 0),
                ) if any(same) and sum(same) >= 8 else (0, 0, 0)
                if best[1] >= decontaminate.LEAST_SPAN and best[2] >= decontaminate.LEAST_SHARE * best[1]:
                    expected.add((doc, item))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    found = pairs(decontaminate.find_contamination(d, spark.createDataFrame(items, "item_id long, text string")))
    assert set(found) == expected


def plain_stretches(same, whole):
    """All stretches that are contamination, by trying each."""
    n = len(same)
    return [
        (x, y)
        for x in range(n)
        for y in range(x + 1, n + 1)
        if 5 * sum(same[x:y]) >= 4 * (y - x)
        and ((y - x >= decontaminate.LEAST_SPAN and same[x] and same[y - 1]) or (whole and y - x == n))
    ]


def test_any_stretch_counts_and_the_longest_is_reported():
    rng = random.Random(3)
    for n in (1, 4, 5, 9, 11, 12, 13, 20, 45):
        for i in range(150):
            same, whole = [rng.random() < (0.65, 0.75, 0.85)[i % 3] for _ in range(n)], i % 2 == 0
            x, y = decontaminate.longest_stretch(np.array(same), whole)
            expected = plain_stretches(same, whole)
            assert y - x == max((b - a for a, b in expected), default=0)
            assert y == x or (x, y) in expected


def test_every_stretch_of_enough_matches_fits_a_mask():
    """Of a stretch of 24 words or more one half fulfils the rule, so these lengths prove all.
    Items of fewer words than LEAST_SPAN are tried whole."""
    for n in range(1, 2 * decontaminate.LEAST_SPAN):
        masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.masks_of(n)]
        places = [frozenset(p + i for i in m) for m in masks for p in range(n - m[-1])]
        # Longer items share the masks of all that are long enough.
        assert n < decontaminate.LEAST_SPAN or decontaminate.masks_of(n) == decontaminate.MASKS
        for gone in itertools.combinations(range(n), n // 5):
            assert any(p.isdisjoint(gone) for p in places)


def test_short_items_with_replaced_words_are_found(spark, words):
    """All items of 5 to 20 words at 80 %, as well as the share allows."""
    items, docs = [], []
    for n in range(5, 21):
        for i in range(20):
            own = prose(words, n, 1000 * n + i)
            items.append((100 * n + i, " ".join(own)))
            for j in random.Random(i).sample(range(n), n // 5):
                own[j] = f"other{j}"
            docs.append((100 * n + i, " ".join(["so", *own, "on"])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    found = pairs(decontaminate.find_contamination(d, spark.createDataFrame(items, "item_id long, text string")))
    assert set(found) == {(i, i) for i, _ in docs}


def test_lines_in_small_parts(spark, words, monkeypatch):
    items = [(i, " ".join(prose(words, 20, i // 2))) for i in range(10)]
    block = decontaminate._Block([i for i, _ in items], pa.array([t for _, t in items]))
    data, offsets = lx.text_bytes(pa.array([f"{items[i % 10][1]} {items[0][1]}" for i in range(30)]))
    own = lx.Words(data, offsets, lx.LETTERS_DIGITS)
    (whole,) = block.lines(own.hashes, own.first)
    monkeypatch.setattr(decontaminate, "MOST_LINES", 7)
    parts = list(block.lines(own.hashes, own.first))
    assert len(parts) > 20
    wordless = decontaminate._Block([1], pa.array(["!!"]))
    assert not list(wordless.lines(own.hashes, own.first))
    assert np.concatenate(parts).tolist() == whole.tolist()


def test_stretches_that_a_largest_sum_trims_or_swallows(spark, words):
    item = prose(words, 60, 77)
    cuts = [
        (12, [1]),  # of the first 12 words the second
        (50, [*range(13, 19), *range(31, 37)]),  # 13 exact words, 12 and 13
        (27, [8, 9, 10, 11, 12, 13, 14, 18, 22]),  # 8 exact words, and 10 of 12
    ]
    docs = []
    for i, (cut, gone) in enumerate(cuts):
        docs.append((i, " ".join(["before", *(f"x{j}" if j in gone else w for j, w in enumerate(item[:cut])), "after"])))
    short = prose(words, 12, 78)
    docs.append((3, " ".join(["other", *short[1:], "words"])))
    docs.append((4, " ".join(["some", *item[:11], "words"])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short))], "item_id long, text string")
    found = pairs(decontaminate.find_contamination(d, b))
    assert {k: (r["doc_start"], r["item_start"], r["span"], r["matched"]) for k, r in found.items()} == {
        (0, 1): (1, 0, 12, 11),
        (1, 1): (1, 0, 31, 25),
        (2, 1): (16, 15, 12, 10),
        (3, 2): (0, 0, 12, 11),
    }
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(d, b).collect()] == [4]


def test_a_benchmark_in_several_blocks(spark, words, monkeypatch):
    items = [(i, " ".join(prose(words, 30, i))) for i in range(9)]
    docs = spark.createDataFrame([(i, "so " + t + " it is") for i, t in items] + [(99, "so it is")], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    whole = pairs(decontaminate.find_contamination(docs, b))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 70)
    assert set(pairs(decontaminate.find_contamination(docs, b))) == set(whole) == {(i, i) for i in range(9)}
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, b).collect()] == [99]


def test_short_items_match_whole(spark):
    b = spark.createDataFrame([(1, "four words stand here"), (2, ""), (3, None), (4, "!!")], "item_id long, text string")
    docs = [(1, "Here: FOUR words, stand here!"), (2, "four words stand there"), (3, "words stand here"), (4, "!!")]
    found = pairs(decontaminate.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), b))
    assert set(found) == {(1, 1)}


def test_odd_rows(spark, odd, nothing):
    b = spark.createDataFrame(
        [(1, "the same row stands here two times over and it is long enough"), (1, "again under one id")],
        "item_id long, text string",
    )
    assert set(pairs(decontaminate.find_contamination(odd, b))) == {(5, 1)}
    kept = decontaminate.drop_contaminated(odd, b)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 2
    assert decontaminate.find_contamination(nothing, b).count() == 0
    assert decontaminate.find_contamination(odd, b.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd, b.limit(0)).count() == odd.count()


def test_query(spark, sf_dir):
    docs, b = ({r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/{n}.parquet").collect()} for n in ("documents", "benchmark"))
    found = pairs(queries.contamination_seeds(spark, sf_dir))
    whole = {(i, j) for i, t in docs.items() for j, s in b.items() if s in t}
    assert whole <= set(found)
