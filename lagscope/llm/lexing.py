"""Words, lines and rolling hashes of many texts at once, as numpy arrays.

Arrow hands a task its texts as one run of UTF-8 bytes with offsets. All functions here
work on such a run, so no Python code runs per word. A run is cut into pieces of about
``PIECE`` bytes at document borders; a longer document is a piece of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
# Odd multipliers of the rolling hashes; both have an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes that end a word: the space and \x09 to \x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WHITE = ~WHITE
#: Bytes of words of letters: ASCII letters and all bytes of longer characters.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LETTERS_DIGITS = LETTERS.copy()
LETTERS_DIGITS[0x30:0x3A] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers so that any of their bits may serve as a hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


class _Kept(dict):
    """A cache that stays where it is: task functions carry this module, and would carry it."""

    def __reduce__(self):
        return _Kept, ()


_powers: dict[str, np.ndarray] = _Kept()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse; kept, as every piece needs them."""
    if len(_powers.get("up", ())) < max(n, 1):
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(max(n, PIECE + PIECE // 4), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any stretch follows; see ``stretch_hashes``."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal stretches, wherever they stand. Lengths are not told apart."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def window_hashes(values: np.ndarray, size: int, sums: np.ndarray | None = None) -> np.ndarray:
    """The hash of every ``size`` consecutive values."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    sums = prefix_hashes(values) if sums is None else sums
    return mix((sums[size:] - sums[:-size]) * powers(len(sums))[1][: len(sums) - size])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, content = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The task function, giving freed memory back when it ends: a worker serves many stages and
    would keep the most that any of them took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return run


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes; every document is in one of them."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of True that do not cross ``offsets``."""
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < len(inside))]
    begins[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Words:
    """The words of some texts: byte positions, hashes, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = NOT_WHITE):
        self.data, self.offsets = data, offsets
        self.starts, self.ends = runs(kinds[data], offsets)
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            sums = prefix_hashes(BYTE_VALUES[self.data])
            self._hashes = stretch_hashes(sums, self.starts, self.ends)
        return self._hashes

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all windows of ``size`` words within one text."""
        hashes = window_hashes(self.hashes, size)
        inside = whole_windows(self.first, size, len(hashes))
        return np.flatnonzero(inside), hashes[inside]


def whole_windows(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n windows of ``size`` units lie within one text."""
    inside = np.ones(n, bool)
    for shift in range(1, size):
        at = first[1:-1] - shift
        inside[at[(at >= 0) & (at < n)]] = False
    return inside


def owners(first: np.ndarray) -> np.ndarray:
    """For every unit the index of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of ``values`` over the units of each text."""
    kind = np.int64 if values.dtype == bool else values.dtype
    sums = np.zeros(len(values) + 1, kind)
    np.cumsum(values, out=sums[1:], dtype=kind)
    return sums[first[1:]] - sums[first[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur at least twice."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))]
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n units lie in one of the stretches."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0
