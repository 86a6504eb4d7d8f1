import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lagscope.llm import lexing as lx
from lagscope.llm import seeds

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0bé中.", max_size=30)), max_size=8)


@given(TEXTS)
@settings(max_examples=80, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = lx.text_bytes(pa.array(texts, pa.string()))
    words = lx.Words(data, offsets)
    found = [data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert found == [w for own in expected for w in own]
    assert words.counts.tolist() == [len(own) for own in expected]


@given(TEXTS)
@settings(max_examples=80, deadline=None)
def test_hashes_are_equal_where_words_are(texts):
    data, offsets = lx.text_bytes(pa.array(texts, pa.string()))
    words = lx.Words(data, offsets)
    found = [data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
    assert len(set(zip(found, words.hashes.tolist(), strict=True))) == len(set(found)) == len(set(words.hashes.tolist()))


@given(TEXTS, st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_windows_stay_within_their_text(texts, size):
    data, offsets = lx.text_bytes(pa.array(texts, pa.string()))
    at, hashes = lx.Words(data, offsets).windows(size)
    lists = [(t or "").encode().split() for t in texts]
    expected = [tuple(w[i : i + size]) for w in lists for i in range(len(w) - size + 1)]
    assert len(at) == len(expected)
    assert sorted(Counter(hashes.tolist()).values()) == sorted(Counter(expected).values())


def test_a_slice_of_a_column_has_its_own_texts():
    column = pa.array(["one", None, "two three", ""]).slice(1, 2)
    data, offsets = lx.text_bytes(column)
    assert (data.tobytes(), offsets.tolist()) == (b"two three", [0, 0, 9])


def test_pieces_hold_every_text_once():
    offsets = np.array([0, 5, 5, 30, 31, 40])
    assert [i for a, b in lx.pieces(offsets, 10) for i in range(a, b)] == [0, 1, 2, 3, 4]


def test_repeated_and_covered():
    assert lx.repeated(np.array([3, 1, 3, 2], np.uint64)).tolist() == [True, False, True, False]
    assert lx.repeated(np.zeros(0, np.uint64)).tolist() == []
    assert lx.covered(np.array([1, 2]), np.array([3, 4]), 5).tolist() == [False, True, True, True, False]


@given(st.lists(st.integers(0, 2), min_size=0, max_size=80), st.integers(0, 3))
@settings(max_examples=100, deadline=None)
def test_regions_hold_every_window_once_and_equal_windows_share_a_seed(units, cut):
    size, k = 9, 4
    values = lx.mix(np.array(units, np.uint64) + np.uint64(1))
    first = np.array([0, min(cut * 17, len(units)), len(units)])
    r = seeds.Regions(values, first, size, k)
    windows = [b + i for b, n in zip(r.begin, r.windows, strict=True) for i in range(n)]
    expected = [i for a, b in zip(first[:-1], first[1:], strict=True) for i in range(a, b - size + 1)]
    assert sorted(windows) == expected
    seed_of = {}
    for b, n, p, s in zip(r.begin, r.windows, r.place, r.seed, strict=True):
        for i in range(n):
            seed_of.setdefault(tuple(units[b + i : b + i + size]), set()).add((int(s), int(p - i)))
    assert all(len(found) == 1 for found in seed_of.values())


def test_seed_places_are_the_same_in_stretches(monkeypatch):
    grams = lx.mix(np.arange(500, dtype=np.uint64) % np.uint64(37))
    whole = seeds._seed_places(grams, 20)
    monkeypatch.setattr(seeds, "PLACE_BITS", 7)
    # Fewer bits keep more of the hash; on these numbers the order is the same.
    assert (seeds._seed_places(grams, 20) == whole).all()


def test_task_functions_do_not_carry_the_cache():
    """The powers are made anew in each worker; sent along, they were 21 MB per function."""
    from pyspark import cloudpickle

    import pyarrow as pa

    from lagscope.llm import decontaminate, interpolation, repeats, search, tokens

    lx.powers(lx.PIECE)
    assert len(lx._powers["up"]) >= lx.PIECE
    items = decontaminate._Block([*"abcdefghij"], pa.array(["some words of an item that is asked about"] * 10))
    assert len(items.seeds) == len(decontaminate.MASKS)
    functions = [
        decontaminate._finder(items), lx.window_hashes, tokens._writer("", ""), interpolation._send(2, 3), search._sign(np.zeros(3, np.uint64)),
        repeats._region_lister(lambda *_: None, 5, 2),
    ]
    for function in functions:
        sent = cloudpickle.dumps(function)
        assert len(sent) < 1 << 19
    assert len(cloudpickle.loads(cloudpickle.dumps(lx._powers))) == 0
