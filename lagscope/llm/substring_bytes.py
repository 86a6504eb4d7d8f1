"""Suffix-array dedup over bytes: difference-cover blockwise construction.

Windows are ``SIZE`` bytes. Open regions (see ``repeats``) are dealt by seed into blocks of
about a megabyte; only windows of one seed can be equal, so a block needs no other. In a
block the suffixes are sorted as in blockwise construction of a suffix array:

* The cover: positions p of the block's text with p mod ``PERIOD`` in ``COVER``. Any two
  positions i, j have a shift d < PERIOD for which both i + d and j + d are in it.
* The suffixes at cover positions are sorted by their first ``REACH`` bytes and ranked.
* The windows are sorted one bucket at a time: bucket d holds the windows that have a
  cover position d bytes on. They are sorted by hashes of their first and last PERIOD bytes
  and the cover position's rank, which covers what lies between; neighbours that agree are
  then compared byte by byte. Two equal windows share a bucket, whatever their positions.

No comparison reads on beyond that, and a task holds one block and one bucket. Seeds with
more than ``LARGE`` bytes of regions have a block each, which a seed's regions (at most
``SIZE`` - ``SEED`` + 1 windows each) keep below 2 MB; the others share blocks.

A seed with more than ``MOST_PER_SEED`` different regions would make a block of its own
size; its windows are counted by their hash in a Spark aggregation instead, which splits.

Null and empty texts have nothing to remove, nor have texts shorter than a window. Equal
rows are removed whole, from a window's length on, as each is the other's repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx
from lagscope.llm import repeats
from lagscope.llm.tables import stored

SIZE = 200
SEED = 48
#: A perfect difference cover: the differences of its members are all residues.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Bytes of a cover suffix that are ranked.
REACH = SIZE - PERIOD
BLOCK_BYTES = 1 << 19
#: Seeds with regions of more bytes than this share a block with no other.
LARGE = 1 << 18
#: Bytes of windows compared at a time.
COMPARED = 1 << 22
MOST_PER_SEED = 1 << 12
CUT = "seed long, content long, twice boolean, name long, length long, begin long, windows long, body binary"
WINDOW = "name long, length long, begin long, windows long"


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return lx.BYTE_VALUES[data], offsets


def _cut(data: np.ndarray, name: int, length: int, regions: dict) -> list[pa.Array]:
    raw = data.tobytes()
    bodies = [raw[b : b + w + SIZE - 1] for b, w in zip(regions["begin"].tolist(), regions["windows"].tolist(), strict=True)]
    n = len(bodies)
    return [
        pa.array(regions["seed"]), pa.array(regions["content"]), pa.array(regions["twice"], pa.bool_()),
        pa.array(np.full(n, name)), pa.array(np.full(n, length)), pa.array(regions["begin"]), pa.array(regions["windows"]),
        pa.array(bodies, pa.binary()),
    ]


def cover_ranks(text: np.ndarray, reach: int) -> np.ndarray:
    """For each position the rank of its suffix's first ``reach`` bytes among all cover
    positions; -1 where the position is not in the cover or fewer bytes follow."""
    n = len(text) - reach + 1
    ranks = np.full(len(text), -1, np.int64)
    if n <= 0:
        return ranks
    at = np.arange(n)
    at = at[np.isin(at % PERIOD, COVER)]
    suffixes = np.lib.stride_tricks.sliding_window_view(text, reach)[at]
    keys = np.ascontiguousarray(suffixes).view(np.dtype((np.void, reach))).ravel()
    ranks[at] = np.unique(keys, return_inverse=True)[1].ravel()
    return ranks


def equal_windows(text: np.ndarray, starts: np.ndarray, keys: np.ndarray, found: np.ndarray, size: int) -> np.ndarray:
    """Which windows have a key that another one shares, and its bytes as well, or were
    ``found`` before: pairs of those need no second look."""
    found = found.copy()
    order = np.argsort(keys, kind="stable")
    pairs = np.flatnonzero((keys[order[1:]] == keys[order[:-1]]) & ~(found[order[1:]] & found[order[:-1]]))
    windows = np.lib.stride_tricks.sliding_window_view(text, size)
    step = max(COMPARED // size, 1)
    for a in range(0, len(pairs), step):
        one, two = order[pairs[a : a + step]], order[pairs[a : a + step] + 1]
        same = (windows[starts[one]] == windows[starts[two]]).all(axis=1)
        found[one[same]] = found[two[same]] = True
        # Keys that meet without their bytes: all windows of such a key are sorted by bytes.
        for key in np.unique(keys[one[~same]]):
            own = np.flatnonzero(keys == key)
            whole = np.ascontiguousarray(windows[starts[own]]).view(np.dtype((np.void, size))).ravel()
            _, at, often = np.unique(whole, return_inverse=True, return_counts=True)
            found[own] |= often[at.ravel()] > 1
    return found


def repeated_windows(text: np.ndarray, starts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Which windows of ``size`` bytes at ``starts`` equal another one of them."""
    reach = size - PERIOD
    found = np.zeros(len(starts), bool)
    if not len(starts):
        return found
    ranks = cover_ranks(text, reach)
    short = lx.window_hashes(lx.BYTE_VALUES[text], PERIOD)
    head, tail = short[starts], short[starts + reach]
    for shift in range(PERIOD):
        bucket = np.flatnonzero(np.isin((starts + shift) % PERIOD, COVER))
        rank = ranks[starts[bucket] + shift].astype(np.uint64)
        keys = head[bucket] ^ lx.mix(tail[bucket] ^ lx.mix(rank + np.uint64(1)))
        found[bucket] = equal_windows(text, starts[bucket], keys, found[bucket], size)
    return found


def _sort_block(table: pa.Table) -> pa.Table:
    """The repeated windows of a block's open regions, as runs."""
    content = table.column("content").to_numpy()
    seed = table.column("seed").to_numpy()
    # A region that several rows brought counts once.
    order = np.lexsort((content, seed))
    new = np.ones(len(order), bool)
    new[1:] = (content[order[1:]] != content[order[:-1]]) | (seed[order[1:]] != seed[order[:-1]])
    rows = order[new]
    table = table.take(pa.array(rows))
    bodies = table.column("body").to_pylist()
    windows, begin = table.column("windows").to_numpy(), table.column("begin").to_numpy()
    text = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = windows + SIZE - 1
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(windows)), windows)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    found = repeated_windows(text, base[owner] + nth)
    # Regions that occur twice are known to repeat; here they are only what others meet.
    found &= ~table.column("twice").to_numpy()[owner]
    starts, ends = lx.runs(found, np.append(np.cumsum(windows) - windows, len(owner)))
    of = owner[starts]
    return pa.table({
        "name": table.column("name").take(pa.array(of)), "length": table.column("length").take(pa.array(of)),
        "begin": pa.array(begin[of] + nth[starts]), "windows": pa.array(ends - starts),
    })


def _hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of every window of a region, where a seed has too many regions."""
    for batch in batches:
        for row in batch.to_pylist():
            values = lx.BYTE_VALUES[np.frombuffer(row["body"], np.uint8)]
            one, two = lx.window_hashes(values, SIZE), lx.window_hashes(lx.mix(values), SIZE)
            n = len(one)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array([row["twice"]] * n, pa.bool_()),
                    *(pa.array(np.full(n, row[c])) for c in ("name", "length")), pa.array(row["begin"] + np.arange(n)),
                    pa.array(np.ones(n, np.int64)),
                ],
                names=["one", "two", "twice", "name", "length", "begin", "windows"],
            )


def _between_open(pieces: DataFrame, most_per_seed: int) -> DataFrame:
    """Windows of open regions that are equal to a window of another region of their seed."""
    regions = pieces.groupBy("seed", "content").agg(F.max(F.length("body")).alias("bytes"))
    per_seed = regions.groupBy("seed").agg(F.count(F.lit(1)).alias("contents"), F.sum("bytes").alias("bytes"))
    per_seed = stored(per_seed, "seeds")
    hot, large = F.col("contents") > most_per_seed, F.col("bytes") > LARGE
    small = per_seed.filter(~hot & ~large).agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-int(small) // BLOCK_BYTES))
    apart = per_seed.filter(hot | large).select("seed", hot.alias("hot"))
    dealt = pieces.join(stored(apart, "seeds-apart"), "seed", "left")
    cool = dealt.filter(~F.coalesce("hot", F.lit(False))).withColumns({
        "alone": F.col("hot").isNotNull(),
        "block": F.when(F.col("hot").isNotNull(), F.col("seed")).otherwise(F.pmod(F.xxhash64("seed"), F.lit(blocks))),
    })
    sorted_out = cool.drop("hot").groupBy("alone", "block").applyInArrow(_sort_block, WINDOW)
    rows = dealt.filter("hot").drop("hot").dropDuplicates(["seed", "content"])
    windows = rows.mapInArrow(_hash_windows, f"one long, two long, twice boolean, {WINDOW}")
    equal = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one", "two")
    hashed = windows.join(equal, ["one", "two"]).filter(~F.col("twice"))
    return sorted_out.unionAll(hashed.select("name", "length", "begin", "windows"))


def _describe(column: pa.Array, spans: list) -> list[pa.Array]:
    rows = []
    for text, own in zip(column.to_pylist(), spans, strict=True):
        raw, n_spans, removed, kept, at = text.encode(), 0, 0, hashlib.sha256(), 0
        for span in own or ():
            # Sorted by start; one that begins where the last ends belongs to it.
            if span["start"] > at or not n_spans:
                kept.update(raw[at : span["start"]])
                n_spans += 1
                at = span["start"]
            removed += max(0, span["end"] - at)
            at = max(at, span["end"])
        kept.update(raw[at:])
        rows.append((len(raw), removed, n_spans, kept.hexdigest()))
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]


def repeated_spans(texts: DataFrame, most_per_seed: int = MOST_PER_SEED) -> DataFrame:
    """(name, length, spans): per text the stretches covered by repeated windows, in bytes."""
    regions = repeats.list_regions(texts, _units, SIZE, SEED)
    whole, opened = repeats.sort_out(regions)
    pieces = stored(repeats.cut_out(texts, opened, _cut, CUT), "pieces")
    return stored(repeats.spans_of(whole.unionByName(_between_open(pieces, most_per_seed)), SIZE), "spans")


def dedup_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", most_per_seed: int = MOST_PER_SEED) -> DataFrame:
    """One row per row of ``docs``: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    texts = repeats.named(docs, key, text)
    spans = repeated_spans(texts, most_per_seed)
    kind = docs.schema[key].dataType.simpleString()
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    described = repeats.take_out(texts, spans, kind, _describe, schema)
    return described.withColumnRenamed("key", key)
