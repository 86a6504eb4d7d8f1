"""Ranked lexical search over bit-sliced Bloom signatures, with exact results.

A document's signature is a Bloom filter of its terms; a term that occurs 2, 4, 8, ... times is
put in once more per doubling. The filters of up to ``MOST_DOCS`` documents of like size lie in
one block as slices: a row per bit, a column per document. The slices of a term, combined by AND,
are the documents that may hold it, and those of its doublings bound how often. From these and
the length of each document follows the most that a term can add to its score; the weighted sum
over an item's terms bounds the score from above, in whole numbers and so without rounding.

The documents with the highest bounds are scored from their texts. The k-th best of those scores
is one that no document of the result falls short of, so every document whose bound reaches it is
scored from its text, and only those below it are left out. Filters say yes too often and never
no by mistake, so the result is that of scoring every document.

Null texts and texts without terms hold no term and are no document here; null and empty items
have no terms and no result. Rows that repeat are ranked one by one; rows of one score come by
key, null keys last. Equal items (id and text) are one item, an id with two texts is ranked for
each. Items are taken in blocks of about ``MOST_TERMS`` words, so what is sent to the tasks does
not grow with the benchmark; each block reads the documents again.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx
from lagscope.llm.tables import row_names, stored

BEST = 10
#: Bits per key of the largest document of a block, before rounding up to a power of two.
BITS = 10
HASHES = 4
MOST_DOCS = 1024
#: Bits of a block's slices.
MOST_CELLS = 1 << 23
#: Texts signed at a time, in bytes.
PIECE = 1 << 22
#: Words of the items searched for at a time; more take more passes.
MOST_TERMS = 1 << 18
#: Rows of (term, document) bounds held at a time.
SLAB = 1 << 12
#: Candidates up to this number are broadcast, some 64 bytes each; more are joined by a shuffle.
MOST_BROADCAST = 1 << 18

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(_FOLD)


def _terms(data: np.ndarray, offsets: np.ndarray) -> lx.Words:
    """Runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""
    return lx.Words(_FOLD[data], offsets, lx.LETTERS_DIGITS)


def _counted(words: lx.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and how often it occurs there, for the different terms of each text."""
    owner, hashes = lx.owners(words.first), words.hashes
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return owner[first], hashes[first], np.diff(np.append(first, len(order)))


def _slots(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The bits of each key: a term together with the number of its doublings."""
    own = lx.mix(hashes + np.uint64(level))
    step = lx.mix(own) | np.uint64(1)
    places = [(own + np.uint64(i) * step) >> np.uint64(32) for i in range(HASHES)]
    return (np.stack(places, axis=-1) & np.uint64(width - 1)).astype(np.int64)


@dataclass(frozen=True)
class Items:
    """Some items: their different terms (hash and bytes), and which terms each has."""

    ids: list
    terms: list[bytes]
    hashes: np.ndarray
    starts: np.ndarray
    term: np.ndarray

    @staticmethod
    def of(ids: list, texts: pa.Array) -> Items:
        words = _terms(*lx.text_bytes(texts))
        owner, hashes, _ = _counted(words)
        known, at = np.unique(words.hashes, return_index=True)
        body = _FOLD[words.data].tobytes()
        terms = [body[words.starts[i] : words.ends[i]] for i in at]
        some, starts = np.unique(owner, return_index=True)
        return Items([ids[i] for i in some], terms, known, starts, np.searchsorted(known, hashes))


# --- the index ----------------------------------------------------------------------------


def _blocks_of(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Documents of like size, and the bits of their filters."""
    order = np.argsort(sizes, kind="stable")[::-1]
    widths = 1 << np.ceil(np.log2(np.maximum(sizes[order], 1) * BITS)).astype(np.int64)
    at = 0
    while at < len(order):
        width = int(widths[at])
        most = min(MOST_DOCS, max(MOST_CELLS // width, 1))
        after = min(at + most, int(np.searchsorted(-widths, -width, "right")))
        yield order[at:after], width
        at = after


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _sign(wanted: np.ndarray):
    """Blocks of signatures, with the counts over their texts: which of the ``wanted`` terms
    occur in how many documents (with the first block of a piece)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lx.text_bytes(batch.column("text"))
            for a, b in lx.pieces(offsets, PIECE):
                words = _terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if not len(words.starts):
                    continue
                owner, hashes, often = _counted(words)
                at = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
                found, held = np.unique(at[wanted[at] == hashes] if len(wanted) else at[:0], return_counts=True)
                levels = np.log2(often).astype(np.int64)
                sizes = np.bincount(owner, levels + 1, minlength=b - a)
                filled = np.flatnonzero(sizes)
                most = np.zeros(b - a, np.int64)
                np.maximum.at(most, owner, often)
                column = {"slices": [], "width": [], "docs": [], "n": [], "most": [], "found": [], "held": []}
                for chosen, width in _blocks_of(sizes[filled]):
                    docs = filled[chosen]
                    seat = np.full(b - a, -1)
                    seat[docs] = np.arange(len(docs))
                    cells = np.zeros((width, -(-len(docs) // 8) * 8), bool)
                    inside = np.flatnonzero(seat[owner] >= 0)
                    for level in range(int(levels[inside].max()) + 1):
                        inside = inside[levels[inside] >= level]
                        cells[_slots(hashes[inside], level, width), seat[owner[inside]][:, None]] = True
                    column["slices"].append(np.packbits(cells, axis=1).tobytes())
                    column["width"].append(width)
                    column["docs"].append(docs + a)
                    column["n"].append(words.counts[docs])
                    column["most"].append(most[docs])
                    first = not column["found"]
                    column["found"].append(found if first else found[:0])
                    column["held"].append(held if first else held[:0])
                keys = batch.column("key").take(pa.array(np.concatenate(column["docs"])))
                names = batch.column("name").take(pa.array(np.concatenate(column["docs"])))
                ends = pa.array(np.cumsum([0, *map(len, column["docs"])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(column["slices"], pa.binary()), pa.array(column["width"], pa.int64()),
                        pa.ListArray.from_arrays(ends, keys), pa.ListArray.from_arrays(ends, names),
                        _lists(column["n"], pa.int64()), _lists(column["most"], pa.int64()),
                        _lists(column["found"], pa.int64()), _lists(column["held"], pa.int64()),
                    ],
                    names=["slices", "width", "keys", "names", "n", "most", "found", "held"],
                )

    return sign


def sign_documents(docs: DataFrame, items: Items, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored signatures of all documents, a block per row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), row_names(F.col(key), F.col(text))["_name"].alias("name"), F.col(text).alias("text"))
    lists = ", ".join(f"{c} array<long>" for c in ("names", "n", "most", "found", "held"))
    signed = rows.mapInArrow(_sign(items.hashes), f"slices binary, width long, keys array<{kind}>, {lists}")
    return stored(signed, "signatures")


@dataclass(frozen=True)
class Weights:
    """What the scores depend on besides the documents: N, L and each term's weight."""

    n_docs: int
    n_terms: int
    weight: np.ndarray

    def length_cost(self, n: int) -> int:
        return 100 - 90 + (90 * n * self.n_docs) // self.n_terms


def weigh(blocks: DataFrame, items: Items) -> Weights:
    n_docs, n_terms = blocks.select(
        F.sum(F.size("n")), F.sum(F.expr("aggregate(n, 0L, (a, x) -> a + x)"))
    ).first()
    held = blocks.select(F.explode(F.arrays_zip("found", "held")).alias("t")).groupBy("t.found").agg(F.sum("t.held").alias("df"))
    df = np.zeros(len(items.terms), np.int64)
    # At most one row per term of the block of items.
    for row in held.collect():
        df[row["found"]] = row["df"]
    n_docs, n_terms = n_docs or 0, n_terms or 0
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    return Weights(n_docs, n_terms, np.array(weight, np.int64))


# --- bounds -------------------------------------------------------------------------------


def _bounds(row: dict, items: Items, weights: Weights) -> np.ndarray:
    """The most that each item (row) can score on each document (column) of a block."""
    width, n = row["width"], row["n"]
    slices = np.frombuffer(row["slices"], np.uint8).reshape(width, -1)
    length = np.array([weights.length_cost(int(x)) for x in n], np.int64)
    top = int(np.log2(row["most"].max()))
    often = [np.minimum((2 << level) - 1, row["most"]) for level in range(top + 1)]
    most = [(1_000_000_000 * tf) // (1000 * tf + 8 * length) for tf in often]
    ends = np.append(items.starts[1:], len(items.term))
    bounds = np.zeros((len(items.starts), len(n)))
    first = 0
    while first < len(items.starts):
        after = max(int(np.searchsorted(ends, items.starts[first] + SLAB, "right")), first + 1)
        used, back = np.unique(items.term[items.starts[first] : ends[after - 1]], return_inverse=True)
        hashes = items.hashes[used]
        adds = np.zeros((len(used), len(n)))
        open_terms, held = np.arange(len(used)), None
        for level in range(top + 1):
            bits = np.bitwise_and.reduce(slices[_slots(hashes[open_terms], level, width)], axis=1)
            held = bits if held is None else bits & held
            some = held.any(axis=1)
            open_terms, held = open_terms[some], held[some]
            if not len(open_terms):
                break
            inside = np.unpackbits(held, axis=1, count=len(n)).view(bool)
            adds[open_terms] = np.where(inside, most[level], adds[open_terms])
        # Whole numbers below 2**53: sums of doubles are exact.
        adds *= weights.weight[used][:, None]
        bounds[first:after] = np.add.reduceat(adds[back], items.starts[first:after] - items.starts[first], axis=0)
        first = after
    return bounds


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Array, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            lists = {c: batch.column(c)[i].values for c in ("keys", "names", "n", "most")}
            block = {c: lists[c].to_numpy() for c in ("n", "most")}
            block |= {"width": batch.column("width")[i].as_py(), "slices": batch.column("slices")[i].as_buffer()}
            yield block, lists["keys"], lists["names"].to_numpy()


def _emit(item: list, keys: list, names: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(item), pa.int32()),
            pa.concat_arrays(keys) if keys else pa.array([], kind),
            pa.array(np.concatenate(names), pa.int64()),
        ],
        names=["item", "key", "name"],
    )


def _highest(items: Items, weights: Weights, best: int):
    """Per task, the documents with the highest bounds of each item."""

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = np.zeros((len(items.starts), 0))
        keys, names, seat = None, np.zeros(0, np.int64), np.zeros((len(items.starts), 0), np.int64)
        for block, own_keys, own_names in _rows(batches):
            bounds = _bounds(block, items, weights)
            high = np.concatenate((high, bounds), axis=1)
            seat = np.concatenate((seat, np.broadcast_to(np.arange(bounds.shape[1]) + len(names), bounds.shape)), axis=1)
            keys = own_keys if keys is None else pa.concat_arrays([keys, own_keys])
            names = np.concatenate((names, own_names))
            if high.shape[1] > best:
                chosen = np.argpartition(-high, best - 1, axis=1)[:, :best]
                high, seat = np.take_along_axis(high, chosen, 1), np.take_along_axis(seat, chosen, 1)
            # Only documents that some item still holds are kept.
            used, back = np.unique(seat, return_inverse=True)
            keys, names, seat = keys.take(pa.array(used)), names[used], back.reshape(seat.shape)
        if keys is not None:
            item, place = np.nonzero(high > 0)
            at = seat[item, place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), keys.take(pa.array(at)), pa.array(names[at]), pa.array(high[item, place].astype(np.int64))],
                names=["item", "key", "name", "bound"],
            )

    return highest


def _reaching(items: Items, weights: Weights, least: np.ndarray):
    """Documents whose bound reaches what the item's result needs at least."""

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, keys, names in _rows(batches):
            item, at = np.nonzero(_bounds(block, items, weights) >= np.maximum(least, 1)[:, None])
            if len(item):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int32()), keys.take(pa.array(at)), pa.array(names[at])], names=["item", "key", "name"]
                )

    return reaching


# --- exact scores -------------------------------------------------------------------------


def _exact(items: Items, weights: Weights):
    ends = np.append(items.starts[1:], len(items.term))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                body = (batch.column("text")[i].as_py() or "").encode().translate(_LOWER)
                counts = Counter(_TERM.findall(body))
                length = weights.length_cost(counts.total())
                for item in batch.column("items")[i].as_py():
                    score = 0
                    for t in items.term[items.starts[item] : ends[item]]:
                        tf = counts.get(items.terms[t], 0)
                        score += int(weights.weight[t]) * ((1_000_000_000 * tf) // (1000 * tf + 8 * length))
                    found.append((i, item, score))
            at, item, score = (list(c) for c in zip(*found, strict=True)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at, pa.int64())), batch.column("name").take(pa.array(at, pa.int64())),
                 pa.array(item, pa.int32()), pa.array(score, pa.int64())],
                names=["key", "name", "item", "score"],
            )

    return exact


def _scored(docs: DataFrame, candidates: DataFrame, items: Items, weights: Weights, key: str, text: str) -> DataFrame:
    """The exact score of every row of ``docs`` that a candidate names, for its items."""
    kind = docs.schema[key].dataType.simpleString()
    own = row_names(F.col("key"), F.lit(""))
    named = candidates.select(own["_key"].alias("_key"), own["_none"].alias("_none"), F.col("name").alias("_name"), "item")
    # At most one element per item of the block.
    named = stored(named.groupBy("_key", "_none", "_name").agg(F.collect_set("item").alias("items")), "search-candidates")
    size = named.agg(F.sum(F.size("items") + F.length("_key"))).first()[0] or 0
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"),
        *(c.alias(n) for n, c in row_names(F.col(key), F.col(text)).items()),
    )
    joined = rows.join(F.broadcast(named) if size <= MOST_BROADCAST else named, ["_key", "_none", "_name"])
    joined = joined.select("key", F.col("_name").alias("name"), "text", "items")
    return joined.mapInArrow(_exact(items, weights), f"key {kind}, name long, item int, score long")


def _ranked(scored: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last(), "name")
    return scored.filter("score > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search_block(docs: DataFrame, items: Items, best: int = BEST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ``best`` documents of each of some items: item (its place in ``items``), rank, key
    and score."""
    kind = docs.schema[key].dataType.simpleString()
    blocks = sign_documents(docs, items, key, text)
    weights = weigh(blocks, items)
    slices = blocks.select("slices", "width", "keys", "names", "n", "most")
    high = slices.mapInArrow(_highest(items, weights, best), f"item int, key {kind}, name long, bound long")
    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "key", "name")
    first = high.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= best)
    reached = _ranked(_scored(docs, first, items, weights, key, text), best).filter(F.col("rank") == best)
    least = np.zeros(len(items.starts), np.int64)
    # One row per item of the block.
    for row in reached.select("item", "score").collect():
        least[row["item"]] = row["score"]
    open_docs = slices.mapInArrow(_reaching(items, weights, least), f"item int, key {kind}, name long")
    return _ranked(_scored(docs, open_docs, items, weights, key, text), best).select("item", "rank", "key", "score")


def search(
    docs: DataFrame, benchmark: DataFrame, best: int = BEST, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The ``best`` documents for every row of ``benchmark``: ``item``, ``rank``, ``key`` and
    ``score``."""
    spark = docs.sparkSession
    asked = benchmark.select(F.col(item).alias("id"), F.col(item_text).alias("text")).dropna(subset=["text"]).distinct()
    bytes_asked = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = 1 + bytes_asked // (2 * MOST_TERMS)
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))), "search-items")
    kinds = f"`{item}` {benchmark.schema[item].dataType.simpleString()}, item int"
    found = []
    for block in range(n_blocks):
        own = asked.filter(F.col("block") == block).orderBy("id", "text").toArrow()
        items = Items.of(own.column("id").to_pylist(), own.column("text"))
        ids = spark.createDataFrame(list(zip(items.ids, range(len(items.ids)), strict=True)), kinds)
        ranked = search_block(docs, items, best, key, text).join(F.broadcast(ids), "item")
        ranked = ranked.select(item, "rank", F.col("key").alias(key), "score")
        found.append(stored(ranked, "search-found") if n_blocks > 1 else ranked)
    return reduce(DataFrame.unionByName, found)
