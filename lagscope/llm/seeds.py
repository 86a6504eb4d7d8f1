"""Seeds: which windows of a text can have an equal elsewhere.

Of every window of ``size`` units the k-gram of the lowest hash (the leftmost of equal
ones) is the window's seed. Equal windows have equal seeds at the same place in them,
so a window whose seed occurs once in all texts has no equal: nothing is lost by leaving
it out. Windows in a row that share a seed form a region, the units that they cover;
about two regions begin per ``size - k + 2`` units.
"""

from __future__ import annotations

import numpy as np

from lagscope.llm import lexing as lx


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive keys, by doubling."""
    out, span = keys, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


#: Bits of a key that hold a place; the rest hold the high bits of a hash.
PLACE_BITS = 26


def _seed_places(grams: np.ndarray, width: int) -> np.ndarray:
    """For every window the leftmost place of its lowest k-gram.

    Hash and place share a number, so its minimum is the leftmost of equal hashes. Cut
    into stretches whose places fit.
    """
    n = len(grams) - width + 1
    step = (1 << PLACE_BITS) - width
    chosen = np.empty(n, np.int64)
    place = np.uint64((1 << PLACE_BITS) - 1)
    for a in range(0, n, step):
        b = min(a + step, n)
        own = grams[a : b + width - 1]
        lowest = _lowest((own & ~place) | np.arange(len(own), dtype=np.uint64), width)
        chosen[a:b] = (lowest & place).astype(np.int64) + a
    return chosen


class Regions:
    """The regions of some texts, given as units with the first unit of each text.

    ``begin`` and ``windows`` are the first window of a region and their number, ``owner``
    its text, ``seed`` and ``content`` hashes of its seed and of all that it covers,
    ``place`` how far from ``begin`` the seed stands.
    """

    def __init__(self, values: np.ndarray, first: np.ndarray, size: int, k: int):
        n = len(values) - size + 1
        empty = np.zeros(0, np.int64)
        self.begin = self.windows = self.owner = self.place = empty
        self.seed = self.content = np.zeros(0, np.uint64)
        if n <= 0:
            return
        sums = lx.prefix_hashes(values)
        grams = lx.window_hashes(values, k, sums)
        chosen = _seed_places(grams, size - k + 1)
        inside = lx.whole_windows(first, size, n)
        change = np.ones(n, bool)
        change[1:] = (chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1])
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], n)
        own = inside[starts]
        starts, ends = starts[own], ends[own]
        # Windows on both sides of a border between texts are apart: some window crosses it.
        self.begin, self.windows = starts, ends - starts
        self.owner = np.searchsorted(first, starts, "right") - 1
        self.place = chosen[starts] - starts
        self.seed = grams[chosen[starts]]
        whole = lx.stretch_hashes(sums, starts, ends - 1 + size)
        shape = (self.place * (size + 1) + self.windows).astype(np.uint64)
        self.content = lx.mix(whole ^ lx.mix(shape + np.uint64(1)))
