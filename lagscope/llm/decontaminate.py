"""Benchmark decontamination by spaced seeds.

A spaced seed is a mask over consecutive words: its hash covers the words under a 1 and
ignores those under a 0, so a passage with some words replaced still shares seeds with
its source. The seeds of the benchmark join those of the documents on their hash; each
hit lines a document up with an item. Along that line any stretch of ``LEAST_SPAN`` words
or more, from a matching word to a matching word, of which ``LEAST_SHARE`` match is
contamination, as is the whole of an item, however short, of which that share matches.
The longest such stretch is reported. Other words at its ends do not lengthen a stretch:
ten or eleven words in a row are not twelve.

Words are runs of letters and digits, lower-cased, so case and punctuation do not hide
a passage. The benchmark joins in blocks of at most ``BLOCK_WORDS`` words: that bounds
what a task holds, and a larger benchmark takes more passes over the documents.

Null and empty texts, and items without words, hit nothing. Items that repeat hit each
under its own id; repeated rows of documents are reported once per (document, item).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx

#: Fixed masks; the first word always counts, as does the last. Any stretch of six words or
#: more that is contamination fits one: two of its runs of matching words with one other word
#: between them, or one run, have five words. The tests try all stretches.
MASKS = ("11111", "101111", "110111", "111011", "111101")
#: Further masks for items of so many words, which may have four in a row at most. Items of fewer than five match as a whole.
MASKS_OF = {5: ("1111", "10111", "11011", "11101"), 10: ("1111001",)}
#: Lines that are compared at a time, about.
MOST_LINES = 1 << 18
LEAST_SPAN = 12
LEAST_SHARE = 0.8
#: The share as a fraction: sums of whole numbers then decide.
PART, OF = Fraction(str(LEAST_SHARE)).as_integer_ratio()
#: A plain alignment's score of a word that does not match, for comparison only: what is
#: found here does not depend on it.
MISMATCH = -2
BLOCK_WORDS = 1 << 20
#: Bits of the filter that most words pass by without a search: 16 per seed, but at most 2 to this.
FILTER_BITS = 22


def masks_of(n: int) -> tuple[str, ...]:
    """The masks of an item of n words."""
    return ("1" * n,) if n < 5 else (*(MASKS if n > 5 else ()), *MASKS_OF.get(n, ()))


def _multipliers(n: int) -> np.ndarray:
    return lx.mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the masked words at every place where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for place, by in zip(range(len(mask)), _multipliers(len(mask)), strict=True):
        if mask[place] == "1":
            total += words[place : place + n] * by
    return lx.mix(total ^ np.uint64(int(mask, 2)))


def _cell(hashes: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """The highest bits of hashes, as many as number the cells of a filter."""
    return (hashes >> np.uint64(65 - len(sieve).bit_length())).astype(np.int64)


class _Block:
    """Items of the benchmark as word hashes. Their seeds, sorted by hash, and a filter over
    them are made in the task that first asks: what is sent is 8 bytes per word."""

    def __init__(self, ids: list, texts: pa.Array):
        data, offsets = lx.text_bytes(pc.utf8_lower(texts))
        words = lx.Words(data, offsets, lx.LETTERS_DIGITS)
        self.ids, self.words, self.first = ids, words.hashes, words.first
        self._made = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_made": None}

    @property
    def seeds(self) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per mask: hashes in order, their items and places, and the filter."""
        if self._made is None:
            counts = np.diff(self.first)
            masks = {int(n): masks_of(int(n)) for n in np.unique(counts) if n}
            self._made = []
            for mask in sorted({mask for some in masks.values() for mask in some}):
                parts = []
                for i in np.flatnonzero(np.isin(counts, [n for n, some in masks.items() if mask in some])):
                    own = seed_hashes(self.words[self.first[i] : self.first[i + 1]], mask)
                    parts.append((own, np.full(len(own), i), np.arange(len(own))))
                hashes, item, place = (np.concatenate(c) for c in zip(*parts, strict=True))
                order = np.argsort(hashes, kind="stable")
                sieve = np.zeros(1 << min(FILTER_BITS, (16 * len(hashes)).bit_length()), bool)
                sieve[_cell(hashes, sieve)] = True
                self._made.append((mask, hashes[order], item[order].astype(np.int64), place[order].astype(np.int64), sieve))
        return self._made

    def lines(self, words: np.ndarray, inside_first: np.ndarray) -> Iterator[np.ndarray]:
        """Rows (text, item, shift): some seed of the item at word p is at word p + shift.
        Each line is in one of the arrays, which hold about MOST_LINES hits or one text's."""
        found = []
        for mask, hashes, _, _, sieve in self.seeds:
            own = seed_hashes(words, mask)
            at = np.flatnonzero(sieve[_cell(own, sieve)])
            owner = np.searchsorted(inside_first, at, "right") - 1
            whole = at + len(mask) <= inside_first[owner + 1]
            at, owner = at[whole], owner[whole]
            low, high = np.searchsorted(hashes, own[at], "left"), np.searchsorted(hashes, own[at], "right")
            hit = high > low
            found.append((at[hit], owner[hit], low[hit], (high - low)[hit]))
        if not found:
            return
        n_of = sum(np.bincount(owner, n, len(inside_first)) for _, owner, _, n in found)
        part = (np.cumsum(n_of) - n_of) // MOST_LINES
        for a, b in zip(*_borders(part), strict=True):
            rows = []
            for (at, owner, low, n), (_, _, item, place, _) in zip(found, self.seeds, strict=True):
                here = slice(*np.searchsorted(owner, (a, b)))
                n = n[here]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                seed = np.repeat(low[here], n) + nth
                rows.append(np.stack((np.repeat(owner[here], n), item[seed], np.repeat(at[here], n) - place[seed]), axis=1))
            yield self._may_hold(np.unique(np.concatenate(rows), axis=0), words, inside_first)

    def _may_hold(self, lines: np.ndarray, words: np.ndarray, inside_first: np.ndarray) -> np.ndarray:
        """The lines with as many matching words as the shortest stretch needs."""
        text, item, shift = lines.T
        length = self.first[item + 1] - self.first[item]
        least = -(-PART * np.minimum(LEAST_SPAN, length) // OF)
        matched = np.zeros(len(lines), np.int64)
        rest = np.arange(len(lines))
        for i in range(int(length.max(initial=0))):
            rest = rest[i < length[rest]]
            at = shift[rest] + i
            inside = (at >= inside_first[text[rest]]) & (at < inside_first[text[rest] + 1])
            some, at = rest[inside], at[inside]
            matched[some] += words[at] == self.words[self.first[item[some]] + i]
            # What has enough need not be compared on.
            rest = rest[matched[rest] < least[rest]]
        return lines[matched >= least]


def _borders(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of equal numbers."""
    begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    return begins, np.append(begins[1:], len(part))


def longest_stretch(same: np.ndarray, whole: bool) -> tuple[int, int]:
    """The longest stretch of which LEAST_SHARE match: all of ``same`` where that is the
    ``whole`` item, or else LEAST_SPAN words or more from a match to a match. (0, 0) if none."""
    sums = np.concatenate(([0], np.cumsum(np.where(same, OF - PART, -PART))))
    if whole and len(same) and sums[-1] >= 0:
        return 0, len(same)
    begins = np.flatnonzero(same)
    if len(begins) * OF < PART * LEAST_SPAN:
        return 0, 0
    ends = begins + 1
    # For each end the first begin whose sum is no higher.
    lowest = np.minimum.accumulate(sums[begins])
    first = np.searchsorted(-lowest, -sums[ends])
    spans = ends - begins[first]
    best = int(spans.argmax())
    if spans[best] < LEAST_SPAN:
        return 0, 0
    return int(ends[best] - spans[best]), int(ends[best])


def _finder(block: _Block, text_column: str = "text", only: bool = False):
    def hits(words: lx.Words) -> Iterator[tuple]:
        lines = block.lines(words.hashes, words.first)
        for text, item, shift in (line for some in lines for line in some):
            start, end = words.first[text], words.first[text + 1]
            own = block.words[block.first[item] : block.first[item + 1]]
            # The part of the item that lies within the text.
            a, b = max(0, start - shift), min(len(own), end - shift)
            same = words.hashes[shift + a : shift + b] == own[a:b]
            x, y = longest_stretch(same, b - a == len(own))
            if y > x:
                yield text, item, int(shift + a + x - start), int(a + x), y - x, int(same[x:y].sum())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lx.text_bytes(pc.utf8_lower(batch.column(text_column)))
            rows, clean = [], np.ones(batch.num_rows, bool)
            for a, b in lx.pieces(offsets):
                words = lx.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lx.LETTERS_DIGITS)
                if not len(words.starts):
                    continue
                for text, item, *rest in hits(words):
                    clean[a + text] = False
                    rows.append((a + text, item, *rest))
            if only:
                yield batch.filter(pa.array(clean))
                continue
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(columns[0], pa.int64())),
                    pa.array([block.ids[i] for i in columns[1]], pa.string()),
                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                ],
                names=["key", "item", "doc_start", "item_start", "span", "matched"],
            )

    return lx.tidy(find)


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[_Block]:
    """The benchmark in blocks of at most BLOCK_WORDS words (or one longer item), by id."""
    ids, texts, held = [], [], 0
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull()
    )
    for row in rows.orderBy("item").toLocalIterator():
        n = len(row["text"].split())
        if ids and held + n > BLOCK_WORDS:
            yield _Block(ids, pa.array(texts, pa.string()))
            ids, texts, held = [], [], 0
        ids.append(row["item"])
        texts.append(row["text"])
        held += n
    if ids:
        yield _Block(ids, pa.array(texts, pa.string()))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per contaminated (document, item): of the longest stretches along its lines the one
    with the most matching words, then the longest, then the first, in words counted
    from 0 in the document (``doc_start``) and the item, its ``span`` and ``matched`` words."""
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"key {kinds[0]}, item string, doc_start long, item_start long, span long, matched long"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = None
    for block in _blocks(benchmark, item, item_text):
        some = rows.mapInArrow(_finder(block), schema)
        found = some if found is None else found.unionAll(some)
    if found is None:
        found = rows.sparkSession.createDataFrame([], schema)
    order = F.struct("matched", "span", -F.col("doc_start"), -F.col("item_start"))
    best = found.groupBy("key", "item").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("n_stretches"))
    return best.select(
        F.col("key").alias(key), F.col("item").cast(kinds[1]).alias(item), (-F.col("best")["col3"]).alias("doc_start"),
        (-F.col("best")["col4"]).alias("item_start"), F.col("best")["span"].alias("span"),
        F.col("best")["matched"].alias("matched"), "n_stretches",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, that no item of the benchmark contaminates."""
    for block in _blocks(benchmark, item, item_text):
        docs = docs.mapInArrow(_finder(block, text, only=True), docs.schema)
    return docs
