import random
import re

import numpy as np
import pytest

from lagscope.llm import near
from lagscope.llm import lexing as lx

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_sets(texts, size):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        shingles = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(shingles or ({tuple(words)} if words else set()))
    return sets


def plain_components(keys, sets, percent):
    label = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(a & sets[j])
                if a and both and 100 * both >= percent * (len(a) + len(sets[j]) - both) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for k, x in zip(keys, label, strict=True):
        if k is not None:
            least[x] = min(k, least.get(x, k))
    return [least.get(x) for x in label]


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies, chains of them, pairs on both sides of the limit, and texts
    that only share a passage."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=120)) for _ in range(25)]
    passage = " ".join(rng.choices(words, k=60))
    for base in list(texts[:6]):
        for _ in range(15):
            own = base.split()
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    chain = texts[7].split()
    for i in range(12):
        chain = [*chain]
        chain[10 * i % 120] = f"c{i}"
        chain[(10 * i + 5) % 120] = f"d{i}"
        texts.append(" ".join(chain))
    texts += [f"{passage} {' '.join(rng.choices(words, k=n))}" for n in (5, 20, 40, 60, 20, 40)]
    texts += [texts[0].upper(), texts[0], "one two", "One TWO", "one", None, "", "  "]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("shingle", [4, 5])
def test_components_equal_a_plain_version(spark, copies, shingle):
    df = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string").repartition(6)
    rows = sorted(near.near_duplicates(df, shingle=shingle).collect(), key=lambda r: r["doc_id"])
    sets = plain_sets(copies, shingle)
    expected = plain_components(range(len(copies)), sets, near.PERCENT)
    assert [r["n_shingles"] for r in rows] == [len(s) for s in sets]
    assert [r["component_id"] for r in rows] == expected
    assert [r["kept"] for r in rows] == [i == c for i, c in enumerate(expected)]
    assert sorted(r["doc_id"] for r in near.keep_one(df, shingle=shingle).collect()) == sorted(set(expected))


def test_odd_rows(odd, nothing):
    rows = near.near_duplicates(odd).collect()
    source = odd.collect()
    sets = plain_sets([r["text"] for r in source], near.SHINGLE)
    expected = plain_components([r["doc_id"] for r in source], sets, near.PERCENT)
    found = sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in rows)
    assert found == sorted((repr(r["doc_id"]), len(s), repr(c)) for r, s, c in zip(source, sets, expected, strict=True))
    kept = near.keep_one(odd)
    assert kept.columns == odd.columns
    # Of two equal rows one stays, whatever else repeats.
    assert kept.count() == odd.count() - 1
    assert near.near_duplicates(nothing).count() == near.keep_one(nothing).count() == 0


def test_a_key_may_repeat_with_linked_texts(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(5, text), (5, text + " more"), (3, text + " less"), (5, "something else that is not near any of them")]
    kept = near.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in kept.collect()) == sorted([rows[2], rows[3]])


def test_links_that_agree_in_few_half_keys_are_confirmed(spark):
    """Pairs of similarity 0.8 that share a table and fewer than five half keys. One of
    each has copies, whose middle is the pivot of both and linked only with that one."""
    texts = []
    for trial in range(30):
        pairs = [(trial * 500 + i, [f"s{trial * 500 + i}x{j}" for j in range(100)]) for i in range(500)]
        sides = [" ".join(part) for _, w in pairs for part in (w[:90], w[:80] + w[90:])]
        offsets = np.cumsum([0, *map(len, sides)])
        keys = near.half_keys(*near.shingle_sets(np.frombuffer("".join(sides).encode(), np.uint8), offsets, 1))
        agree = keys[::2] == keys[1::2]
        tables = agree[:, : near.GROUPS].sum(axis=1) * agree[:, near.GROUPS :].sum(axis=1)
        for i in np.flatnonzero((tables > 0) & (agree.sum(axis=1) < 5)):
            n, w = pairs[i]
            copies = [w[1:90] + [f"m{n}", f"c{n}x{k}"] for k in range(6)]
            texts.append([" ".join(t) for t in (w[:90], w[:80] + w[90:], *copies)])
    assert len(texts) > 2
    rows = [(100 * g + i, t) for g, group in enumerate(texts) for i, t in enumerate(group)]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i // 100 * 100 for i, _ in rows}


def test_minhashes_estimate_similarity():
    rng = np.random.default_rng(2)
    shared = lx.mix(rng.integers(0, 1 << 62, 800).astype(np.uint64))
    a, b = (np.concatenate((shared, lx.mix(rng.integers(0, 1 << 62, 100).astype(np.uint64)))) for _ in range(2))
    keys = near.half_keys(np.concatenate((a, b)), np.array([0, 900, 1800]))
    agree = (keys[0] == keys[1]).mean()
    assert 0.2 < agree < 0.85  # 0.8 ** HASHES is 0.51


def test_parities_never_differ_in_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(3)
    all_hashes = lx.mix(rng.integers(0, 1 << 62, 4000).astype(np.uint64))
    for shared, own in ((300, 20), (100, 100), (2000, 900), (0, 5), (7, 0)):
        a = all_hashes[: shared + own]
        b = np.concatenate((all_hashes[:shared], all_hashes[2900 : 2900 + own]))
        x, y, none = near.parities(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b), len(a) + len(b)]))
        assert not none.any()
        bits = int(np.bitwise_count(x ^ y).sum())
        assert bits <= 2 * own
        assert own > 100 or bits >= 1.4 * own


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r["node"]: r["label"] for r in near.components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
