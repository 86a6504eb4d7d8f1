import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from compare import database, differences

from lagscope.llm import queries, repeats, substring_bytes, substring_words


def removed(units, size):
    """For each row the units covered by a window that stands twice."""
    seen = Counter(u[i : i + size] for u in units for i in range(len(u) - size + 1))
    marks = []
    for u in units:
        own = [False] * len(u)
        for i in range(len(u) - size + 1):
            if seen[u[i : i + size]] > 1:
                own[i : i + size] = [True] * size
        marks.append(own)
    return marks


def expected_bytes(texts):
    units = [(t or "").encode() for t in texts]
    rows = []
    for u, own in zip(units, removed(units, substring_bytes.SIZE), strict=True):
        kept = bytes(b for b, gone in zip(u, own, strict=True) if not gone)
        spans = sum(gone and (i == 0 or not own[i - 1]) for i, gone in enumerate(own))
        rows.append((len(u), sum(own), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def expected_words(texts):
    units = [tuple((t or "").encode().split()) for t in texts]
    rows = []
    for u, own in zip(units, removed(units, substring_words.SIZE), strict=True):
        kept = b" ".join(w for w, gone in zip(u, own, strict=True) if not gone)
        rows.append((len(u), sum(own), hashlib.sha256(kept).hexdigest()))
    return rows


@pytest.fixture(scope="module")
def tangled():
    """Passages shared in pieces, shifted, nested, touching, within one text, and at its ends."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    shared = [prose(n) for n in (36, 60, 90, 140)]
    texts = [None, "", prose(20), shared[1], shared[1], "a" * 450, "ab" * 300, "z z " * 60, "z z " * 50 + prose(3)]
    for i in range(40):
        parts = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(1, 3)):
            whole = rng.choice(shared).split(" ")
            a = rng.randint(0, len(whole) // 2)
            parts += [" ".join(whole[a : a + rng.randint(20, 100)]), prose(rng.choice((0, 1, 25)))]
        texts.append(("\n" if i % 2 else " ").join(parts))
    return texts


def rows_of(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("most_per_seed", [1 << 12, 1])
def test_bytes_equal_a_plain_version(spark, tangled, most_per_seed):
    df = spark.createDataFrame(list(enumerate(tangled)), "doc_id long, text string").repartition(5)
    assert rows_of(substring_bytes.dedup_bytes(df, most_per_seed=most_per_seed)) == expected_bytes(tangled)


def test_words_equal_a_plain_version(spark, tangled):
    df = spark.createDataFrame(list(enumerate(tangled)), "doc_id long, text string").repartition(5)
    assert rows_of(substring_words.dedup_words(df)) == expected_words(tangled)


@pytest.mark.parametrize("dedup, expected", [
    (substring_bytes.dedup_bytes, expected_bytes), (substring_words.dedup_words, expected_words),
])
def test_odd_rows(odd, nothing, dedup, expected):
    rows = odd.collect()
    found = sorted(tuple(r)[1:] for r in dedup(odd).collect())
    assert found == sorted(expected([r["text"] for r in rows]))
    assert dedup(nothing).count() == 0


def test_cover_holds_every_difference():
    differences_held = {(a - b) % substring_bytes.PERIOD for a in substring_bytes.COVER for b in substring_bytes.COVER}
    assert differences_held == set(range(substring_bytes.PERIOD))


def test_windows_of_a_block():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 2, 3000).astype(np.uint8)
    text[1000:1250] = text[100:350]
    starts = np.arange(len(text) - 199)
    found = substring_bytes.repeated_windows(text, starts)
    raw = text.tobytes()
    seen = Counter(raw[i : i + 200] for i in starts)
    assert found.tolist() == [seen[raw[i : i + 200]] > 1 for i in starts]


def test_a_full_filter_loses_nothing(spark, tangled, monkeypatch):
    monkeypatch.setattr(repeats, "FILTER_SIZE", 8)
    df = spark.createDataFrame(list(enumerate(tangled)), "doc_id long, text string")
    assert rows_of(substring_words.dedup_words(df)) == expected_words(tangled)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), database(sf_dir), queries.ORACLES[name]) == []


@pytest.mark.parametrize("n_keys", [1, 7, 1 << 40])
def test_keys_that_collide_do_not_decide(n_keys):
    """Windows are equal by their bytes, whatever their keys."""
    rng = np.random.default_rng(2)
    text = rng.integers(0, 2, 1500).astype(np.uint8)
    text[900:1200] = text[100:400]
    starts = np.arange(len(text) - 199)
    raw = text.tobytes()
    kinds = {}
    own = np.array([kinds.setdefault(raw[i : i + 200], len(kinds)) for i in starts], np.uint64)
    found = substring_bytes.equal_windows(text, starts, own % np.uint64(n_keys), np.zeros(len(starts), bool), 200)
    seen = Counter(own.tolist())
    assert found.tolist() == [seen[x] > 1 for x in own.tolist()]


def test_copies_are_cut_once(spark, monkeypatch):
    """A text's regions are stored once per task that cuts it, however many rows hold it."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    shared = " ".join(rng.choices(words, k=80))
    one, two = (" ".join([*rng.choices(words, k=60), shared, *rng.choices(words, k=60)]) for _ in range(2))
    held = {}
    real = substring_bytes.stored

    def watch(df, purpose):
        held[purpose] = real(df, purpose)
        return held[purpose]

    monkeypatch.setattr(substring_bytes, "stored", watch)
    texts = [one] * 1500 + [two]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = rows_of(substring_bytes.dedup_bytes(df))
    assert found[0][1] == len(one) and found[-1][1] >= len(shared)
    pieces = held["pieces"]
    assert pieces.count() <= 6 * pieces.dropDuplicates(["name", "length", "begin"]).count() < 200


def test_large_seeds_have_blocks_of_their_own(spark, tangled, monkeypatch):
    monkeypatch.setattr(substring_bytes, "LARGE", 500)
    monkeypatch.setattr(substring_bytes, "BLOCK_BYTES", 2000)
    df = spark.createDataFrame(list(enumerate(tangled)), "doc_id long, text string")
    assert rows_of(substring_bytes.dedup_bytes(df)) == expected_bytes(tangled)
