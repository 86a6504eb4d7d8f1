"""Substring dedup over words: compaction of a De Bruijn graph.

Every window of ``SIZE`` words is an edge from the node of its first SIZE - 1 words to the
node of its last ones. An edge that stands in two places is repeated. Regions that repeat
whole (see ``repeats``) are paths from the start; the windows of the open ones become rows
(from, to, text, place), and Spark joins do the rest:

* Edges are counted by their two nodes and an independent hash of all their words. Two
  places, as (text, word), must differ and agree in all three: that verifies the edge.
* Nodes with several repeated edges in or out are forks.
* Along each text, repeated edges in a row whose inner nodes are no forks compact into one
  path, which becomes a span of words at its source coordinates.

Words are as they stand, separated by the space and \\x09 to \\x0D. Null, empty and short
texts have nothing to remove. Equal rows are each other's repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx
from lagscope.llm import repeats
from lagscope.llm.tables import stored

SIZE = 35
SEED = 10
EDGE = "node long, next long, check long, twice boolean, name long, length long, place long"


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = lx.Words(data, offsets)
    return words.hashes, words.first


def _cut(data: np.ndarray, name: int, length: int, regions: dict) -> list[pa.Array]:
    """The edges of the open regions of one text."""
    hashes = lx.Words(data, np.array([0, len(data)])).hashes
    nodes = lx.window_hashes(hashes, SIZE - 1)
    checks = lx.window_hashes(lx.mix(hashes ^ np.uint64(0xC4EC)), SIZE)
    n = regions["windows"]
    place = np.repeat(regions["begin"], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return [
        pa.array(nodes[place].view(np.int64)), pa.array(nodes[place + 1].view(np.int64)),
        pa.array(checks[place].view(np.int64)), pa.array(np.repeat(regions["twice"], n), pa.bool_()),
        pa.array(np.full(len(place), name)), pa.array(np.full(len(place), length)), pa.array(place, pa.int64()),
    ]


def compact(edges: DataFrame) -> DataFrame:
    """(name, length, begin, windows): the paths of repeated edges along each text.

    ``twice`` marks edges of regions that are known to repeat: they are what others meet.
    """
    edge = ["node", "next", "check"]
    where = F.xxhash64("name", "length", "place")
    counted = edges.groupBy(*edge).agg(F.min(where).alias("one"), F.max(where).alias("other"), F.max("twice").alias("twice"))
    repeated = stored(counted.filter((F.col("one") != F.col("other")) | F.col("twice")).select(*edge), "repeated")
    ways = repeated.select("node", "next").distinct()
    forks = (
        ways.select("node", F.lit(1).alias("out"), F.lit(0).alias("into"))
        .unionAll(ways.select(F.col("next"), F.lit(0), F.lit(1)))
        .groupBy("node")
        .agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
        .filter((F.col("out") > 1) | (F.col("into") > 1))
        .select(F.col("node").alias("next"), F.lit(True).alias("fork"))
    )
    own = edges.filter(~F.col("twice")).join(repeated, edge).dropDuplicates(["name", "length", "place"])
    own = own.select("next", "name", "length", "place").join(forks, "next", "left")
    along = Window.partitionBy("name", "length").orderBy("place")
    follows = (F.lag("place").over(along) == F.col("place") - 1) & F.lag("fork").over(along).isNull()
    numbered = own.withColumn("new", F.when(follows, 0).otherwise(1)).withColumn("path", F.sum("new").over(along))
    paths = numbered.groupBy("name", "length", "path").agg(F.min("place").alias("begin"), F.count(F.lit(1)).alias("windows"))
    return paths.select("name", "length", "begin", "windows")


def _describe(column: pa.Array, spans: list) -> list[pa.Array]:
    rows = []
    for text, own in zip(column.to_pylist(), spans, strict=True):
        words, kept, at, removed = text.encode().split(), [], 0, 0
        for span in own or ():
            kept += words[at : span["start"]]
            removed += max(0, span["end"] - max(at, span["start"]))
            at = max(at, span["end"])
        kept += words[at:]
        rows.append((len(words), removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return [*(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2], pa.string())]


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(name, length, spans): per text the stretches covered by repeated windows, in words."""
    regions = repeats.list_regions(texts, _units, SIZE, SEED)
    whole, opened = repeats.sort_out(regions)
    edges = stored(repeats.cut_out(texts, opened, _cut, EDGE), "edges")
    return stored(repeats.spans_of(whole.unionByName(compact(edges)), SIZE), "spans")


def dedup_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_words``, ``n_removed``, ``kept_sha256``."""
    texts = repeats.named(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    schema = "n_words long, n_removed long, kept_sha256 string"
    described = repeats.take_out(texts, repeated_spans(texts), kind, _describe, schema)
    return described.withColumnRenamed("key", key)
