"""Values that occur more than once, found without sending every value.

A count of all values sends each of them, and on a table where they hardly repeat nothing is
combined before the shuffle. Here every value is hashed to one of many places first, and the
tasks send the places they saw, sorted and as differences: a few bytes per value, however wide
it is. A place that was seen twice is suspect. Only values at suspect places are then sent and
counted, so hashes decide nothing: two values that share a place are told apart there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.operators.quality import _results, _text
from lagscope.sources.landing import materialize_observed

#: Places are so many that about 2 to this are shared by chance, and at least 16 per value.
CHANCE_BITS = 18
MOST_BITS = 62
#: Values whose places a task holds at a time, and values per slice of the places, about.
CHUNK = 1 << 22
SLICE_BITS = 20
#: Suspect places that are broadcast, 8 bytes each. Beyond it all values are counted.
MOST_SENT = 1 << 20


def _bits(n: int) -> tuple[int, int]:
    """Bits of a place among n values, and those of them that name its slice."""
    size = max(n, 1).bit_length()
    bits = min(max(2 * size - CHANCE_BITS, size + 4), MOST_BITS)
    return bits, max(size - SLICE_BITS, 0)


def _packed(places: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted places with a mark each, as differences, their lowest bytes first: the shuffle's
    compression leaves nothing of the highest."""
    steps = np.diff(places, prepend=0).astype(np.uint64) << np.uint64(1) | twice.astype(np.uint64)
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(sent: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.frombuffer(sent, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()
    return np.cumsum(steps >> np.uint64(1)).astype(np.int64), (steps & np.uint64(1)).astype(bool)


def _sketch(bits: int, slice_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    below = bits - slice_bits

    def sketched(held: list[np.ndarray]) -> pa.RecordBatch:
        places, n = np.unique(np.concatenate(held), return_counts=True)
        slices, begins = np.unique(places >> below, return_index=True)
        within = places & ((1 << below) - 1)
        ends = np.append(begins[1:], len(places))
        sent = [_packed(within[a:b], n[a:b] > 1) for a, b in zip(begins, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(slices), pa.array(sent, pa.binary())], names=["slice", "places"])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy())
                n += batch.num_rows
            if n >= CHUNK:
                yield sketched(held)
                held, n = [], 0
        if held:
            yield sketched(held)

    return sketch


def _seen_twice(bits: int, slice_bits: int) -> Callable[[pa.Table], pa.Table]:
    below = bits - slice_bits

    def merge(table: pa.Table) -> pa.Table:
        parts = [_unpacked(sent) for sent in table.column("places").to_pylist()]
        places, first, n = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True, return_counts=True)
        marked = np.bincount(first, np.concatenate([t for _, t in parts]), len(places)) > 0
        own = table.column("slice")[0].as_py() << below
        return pa.table({"place": pa.array(places[(n > 1) | marked] + own, pa.int64())})

    return merge


def _cells(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    values = ", ".join(f"{_text(c)}, CAST(`{c}` AS STRING)" for c in columns)
    return df.select(*keys, F.expr(f"stack({len(columns)}, {values}) AS (`column`, `text`)")).filter("`text` IS NOT NULL")


def _placed(cells: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    own = F.xxhash64("column", *keys, "text")
    return cells.withColumn("place", F.shiftrightunsigned(own, 64 - bits))


def suspect_places(df: DataFrame, columns: Sequence[str], keys: Sequence[str], n: int) -> DataFrame:
    """The places that two rows or more of ``df`` share, of n values in all."""
    bits, slice_bits = _bits(n)
    places = _placed(_cells(df, columns, keys), keys, bits).select("place")
    sketches = places.mapInArrow(_sketch(bits, slice_bits), "slice long, places binary")
    return sketches.groupBy("slice").applyInArrow(_seen_twice(bits, slice_bits), "place long")


def repeated_values(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(``keys``, column, text, n): the values that occur n > 1 times, or so per ``keys``. NULL
    is no value; null keys are equal. Building the frame reads ``df`` once, using it again.

    A value that fills a third of the rows is one place per chunk of a task, and one row per task
    when it is counted.
    """
    n = df.count() * len(columns)
    suspects, found = materialize_observed(suspect_places(df, columns, keys, n), "suspects", n=F.count(F.lit(1)))
    cells = _cells(df, columns, keys)
    if found["n"] <= MOST_SENT:
        placed = _placed(cells, keys, _bits(n)[0])
        cells = placed.join(F.broadcast(suspects), "place", "left_semi").drop("place")
    return cells.groupBy(*keys, "column", "text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_failures_of_repeats(
    df: DataFrame, model: str, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """As ``quality.unique_failures``, for large tables whose values hardly repeat."""
    repeats = repeated_values(df, columns, keys)
    return _results(repeats.agg(*(F.expr(f"count_if(`column` = {_text(c)}) AS `{c}`") for c in columns)), model, "unique", columns)
