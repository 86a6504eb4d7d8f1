"""Stretches that occur twice: what both substring operators share.

A text is a row of units (bytes or words); a window is ``size`` units in a row. Wanted is
every window whose units also stand somewhere else. The steps:

1. Each text is cut into regions by the seeds of its windows (``seeds``). Regions of one
   seed are the only ones that can hold equal windows. Before anything is shuffled, equal
   regions of a batch of documents are counted together.
2. Per seed, the occurrences and the different regions are counted. A region that occurs
   twice repeats whole. One whose seed is nowhere else does not repeat. Left are the
   different regions of one seed, one of each: they are *open*.
3. The units of open regions are cut out of their texts, and the operator finds the
   windows among them that are equal.
4. Repeated windows become spans per text, and the texts are read once more to take
   them out.

Texts are named by a 64-bit hash and their length; equal texts have one name, so copies,
repeated rows, repeated and null keys need no care. A filter of ``FILTER_SIZE`` bits, the
same at every input size, tells most texts that a step does not need, before they are
shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx
from lagscope.llm.seeds import Regions
from lagscope.llm.tables import stored

FILTER_SIZE = 1 << 22
REGION = "seed long, content long, n long, name long, length long, begin long, windows long, place long"

#: Units of a piece of text: their hashes, and the first of each text.
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, name, length): a null text is empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("key"), whole.alias("text"), F.xxhash64(whole).alias("name"), F.octet_length(whole).cast("long").alias("length")
    )


def _region_lister(units: Units, size: int, k: int):
    def list_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lx.text_bytes(batch.column("text"))
            name = batch.column("name").to_numpy()
            length = batch.column("length").to_numpy()
            found = []
            for a, b in lx.pieces(offsets):
                values, first = units(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                r = Regions(values, first, size, k)
                at = r.begin - first[r.owner]
                found.append((r.seed, r.content, name[a:b][r.owner], length[a:b][r.owner], at, r.windows, r.place))
            if not found:
                continue
            seed, content, name, length, begin, windows, place = (np.concatenate(c) for c in zip(*found, strict=True))
            # Equal regions side by side; the first of them stands for all.
            order = np.lexsort((content, seed))
            new = np.ones(len(order), bool)
            new[1:] = (seed[order][1:] != seed[order][:-1]) | (content[order][1:] != content[order][:-1])
            heads = np.flatnonzero(new)
            n = np.diff(np.append(heads, len(order)))
            first = order[heads]
            # Those that the first stands for have an equal: they are done, and carry n = 0.
            again = order[~new]
            # Copies of a text name the same regions: one of each is enough.
            again = again[np.unique(lx.mix(name[again].view(np.uint64) ^ lx.mix(begin[again].astype(np.uint64))), return_index=True)[1]]
            rows = np.concatenate((first, again))
            counts = np.concatenate((n, np.zeros(len(again), np.int64)))
            columns = [
                seed[rows].view(np.int64), content[rows].view(np.int64), counts,
                *(c[rows] for c in (name, length, begin, windows, place)),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in REGION.split(", ")]
            )

    return list_regions


def list_regions(texts: DataFrame, units: Units, size: int, k: int) -> DataFrame:
    """Regions of all texts. ``n`` = 0 marks one with an equal that another row stands for."""
    return texts.select("text", "name", "length").mapInArrow(_region_lister(units, size, k), REGION)


def sort_out(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, length, start, windows) of regions that repeat whole, and the open regions:
    one of each content whose seed has several, ``twice`` where it repeats."""
    counted = regions.filter(F.col("n") > 0)
    seeds = (
        counted.groupBy("seed")
        .agg(F.sum("n").alias("of_seed"), F.min("content").alias("low"), F.max("content").alias("high"))
        .filter(F.col("of_seed") > 1)
        .select("seed", (F.col("low") != F.col("high")).alias("several"))
    )
    live = stored(counted.join(seeds, "seed"), "live")
    totals = live.groupBy("seed", "content").agg(
        F.sum("n").alias("total"), F.max("several").alias("several"),
        F.min(F.struct("name", "length", "begin", "windows", "place")).alias("one"),
    )
    totals = stored(totals, "totals")
    whole = live.join(totals.filter(F.col("total") > 1).select("seed", "content"), ["seed", "content"])
    spans = whole.select("name", "length", "begin", "windows").unionByName(
        regions.filter(F.col("n") == 0).select("name", "length", "begin", "windows")
    )
    opened = totals.filter("several").select("seed", "content", (F.col("total") > 1).alias("twice"), "one.*")
    return spans, opened


def name_filter(names: DataFrame) -> np.ndarray:
    """One bit per hash of the names; its size does not depend on the input."""
    bits = np.zeros(FILTER_SIZE, bool)
    places = names.select(F.pmod("name", F.lit(FILTER_SIZE)).cast("int").alias("bit")).distinct().toArrow()
    bits[places.column("bit").to_numpy()] = True
    return bits


def may_be_named(bits: np.ndarray):
    """Keep the rows whose name passes the filter."""
    packed = np.packbits(bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("name").to_numpy() % FILTER_SIZE
            yield batch.filter(pa.array((packed[place >> 3] >> (7 - (place & 7))) & 1 == 1))

    return keep


class _Seen:
    """Keeps the first row of each text that a task meets: its copies hold the same regions."""

    def __init__(self):
        self.names: set[tuple[int, int]] = set()

    def first(self, batch: pa.RecordBatch) -> list[int]:
        chosen = []
        names = zip(batch.column("name").to_pylist(), batch.column("length").to_pylist(), strict=True)
        for i, name in enumerate(names):
            if name not in self.names:
                self.names.add(name)
                chosen.append(i)
        return chosen


def once_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = _Seen()
    for batch in batches:
        yield batch.take(pa.array(seen.first(batch), pa.int64()))


def cut_out(texts: DataFrame, opened: DataFrame, cut, schema: str) -> DataFrame:
    """Bring the open regions to their texts; ``cut(data, regions)`` yields rows of ``schema``.

    ``regions`` are dicts of one text. Of equal texts a task sends one, and what meets them
    cuts one, so neither texts nor regions grow with the number of copies; those that several
    tasks cut all the same are dropped by what follows.
    """
    columns = ("seed", "content", "twice", "begin", "windows", "place")
    wanted = opened.groupBy("name", "length").agg(F.collect_list(F.struct(*columns)).alias("regions"))
    few = texts.select("text", "name", "length")
    few = few.mapInArrow(may_be_named(name_filter(opened)), few.schema).mapInArrow(once_a_task, few.schema)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            text, regions = batch.column("text"), batch.column("regions")
            for i in seen.first(batch):
                own = regions[i].values
                fields = {c: own.field(c).to_numpy(zero_copy_only=False) for c in columns}
                data = np.frombuffer(text[i].as_py().encode(), np.uint8)
                rows = cut(data, batch.column("name")[i].as_py(), batch.column("length")[i].as_py(), fields)
                yield pa.RecordBatch.from_arrays(rows, names=names)

    return few.join(wanted, ["name", "length"]).select("text", "name", "length", "regions").mapInArrow(run, schema)


def spans_of(windows: DataFrame, size: int) -> DataFrame:
    """(name, length, begins, ends): runs of windows as spans of units, per text."""
    ends = (F.col("begin") + F.col("windows") + F.lit(size - 1)).alias("end")
    return windows.groupBy("name", "length").agg(
        F.sort_array(F.collect_set(F.struct(F.col("begin").alias("start"), ends))).alias("spans")
    )


def take_out(texts: DataFrame, spans: DataFrame, kind: str, describe, schema: str) -> DataFrame:
    """``describe(batch_texts, starts, ends)`` rows for all texts, without their spans.

    Texts that no span can name are described where they are read; the others meet their
    spans.
    """
    bits = name_filter(spans)
    may = may_be_named(bits)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("spans").to_pylist() if "spans" in batch.schema.names else [None] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *describe(batch.column("text"), own)], names=["key", *names]
            )

    def pass_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.isin(np.arange(batch.num_rows), _places_of(batch, may))
            yield from run(iter([batch.filter(pa.array(~hit))]))

    fields = f"key {kind}, {schema}"
    aside = texts.mapInArrow(pass_by, fields)
    few = texts.mapInArrow(may, texts.schema)
    met = few.join(spans, ["name", "length"], "left").select("key", "text", "spans").mapInArrow(run, fields)
    return aside.unionAll(met)


def _places_of(batch: pa.RecordBatch, may) -> np.ndarray:
    """Rows of the batch that pass the filter."""
    numbered = pa.RecordBatch.from_arrays(
        [batch.column("name"), pa.array(np.arange(batch.num_rows))], names=["name", "row"]
    )
    (kept,) = may(iter([numbered]))
    return kept.column("row").to_numpy()

