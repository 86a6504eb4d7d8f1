"""Language ID by prediction by partial matching.

For each language a tree of byte contexts up to ``ORDER`` bytes deep is counted. A byte
costs the bits of its share in the longest context that has seen it, and for each longer
context that has not, the bits of an escape (method C: the number of different bytes seen
there over all). The language whose frozen tree codes a text in the fewest bits is
predicted; the score is its share among the languages, each weighed by two to the minus
its code length.

Bytes are folded to 64 symbols (letters of ASCII, lower half and leading bytes of longer
characters, all else one gap; runs of gaps count once), so a tree cannot have more than
64**4 paths. All paths seen ``LEAST_SEEN`` times or more in the training text count. The tasks
are sent, of each language, as many of the most frequent ones as its equal share of
``MOST_PATHS``, so what is sent does not depend on the input. Where a language has more, with a
warning, the costs of all its paths are computed in Spark and stored, and the tasks read them
from there, one language at a time, and correct the code lengths by those not in memory.

A null text, or one without a letter, is ``und`` with score 0. Rows without a language
or a text teach nothing; without any lesson every text is ``und``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx
from lagscope.llm.tables import stored
from lagscope.session import scratch_dir

ORDER = 3
BITS = 6
LEAST_SEEN = 2
MOST_PATHS = 1 << 20
UNKNOWN = "und"
GAP = 0
#: What is stored of a language: costs of paths, of escapes by context, and counts of paths that
#: are one context symbol shorter.
OWN, ESCAPE, SHORTER = range(3)

SYMBOL = np.zeros(256, np.uint8)
SYMBOL[0x61:0x7B] = np.arange(1, 27)
SYMBOL[0x41:0x5B] = np.arange(1, 27)
SYMBOL[0x80:0xC0] = 27 + (np.arange(0x80, 0xC0) & 31)
SYMBOL[0xC0:0xC4] = 59
SYMBOL[0xC4:0xD0] = 60
SYMBOL[0xD0:0xE0] = 61
SYMBOL[0xE0:0xF0] = 62
SYMBOL[0xF0:] = 63


def _paths(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol that counts its path (``ORDER`` symbols before it, and itself) and
    its text. A text begins after gaps."""
    symbols = SYMBOL[data]
    owner = lx.owners(offsets)
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != GAP) | (symbols[:-1] != GAP) | (owner[1:] != owner[:-1])
    symbols, owner = symbols[keep], owner[keep]
    path = symbols.astype(np.int32)
    place = np.arange(len(symbols)) - np.searchsorted(owner, owner) if len(owner) else np.zeros(0, np.int64)
    for back in range(1, ORDER + 1):
        before = np.zeros(len(symbols), np.int32)
        before[back:] = symbols[:-back] if back < len(symbols) else 0
        before[place < back] = GAP
        path |= before << (BITS * back)
    return path, owner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.utf8_lower(batch.column("text"))
        for lang in pc.unique(batch.column("lang")).to_pylist():
            data, offsets = lx.text_bytes(texts.filter(pc.equal(batch.column("lang"), lang)))
            parts = []
            for a, b in lx.pieces(offsets):
                path, _ = _paths(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                parts.append(np.unique(path, return_counts=True))
            paths = np.concatenate([p for p, _ in parts])
            found, place = np.unique(paths, return_inverse=True)
            n = np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(n)],
                names=["lang", "path", "n"],
            )


def fit_trees(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Count the paths of all labelled texts; returns the frozen statistics."""
    lessons = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    counted = stored(
        lessons.mapInArrow(_count, "lang string, path int, n long")
        .groupBy("lang", "path")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_SEEN),
        "context-paths",
    )
    # One row per language.
    held = {r["lang"]: r["paths"] for r in counted.groupBy("lang").agg(F.count(F.lit(1)).alias("paths")).collect()}
    langs = sorted(held, key=lambda s: [ord(c) for c in s])
    share = max(MOST_PATHS // max(len(langs), 1), 1)
    cut = [name for name in langs if held[name] > share]
    if cut:
        warnings.warn(
            f"context trees in memory cut to the {share} most frequent paths each: {', '.join(cut)}; the others are read from files",
            stacklevel=2,
        )
    # A language has at most 64**4 paths, whatever its share of the texts.
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "path")
    paths = counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= share).drop("place").toArrow()
    lang_of, path, n = (paths.column(c) for c in ("lang", "path", "n"))
    trees = {}
    for name in langs:
        chosen = pc.equal(lang_of, name)
        own = path.filter(chosen).to_numpy(), n.filter(chosen).to_numpy()
        order = np.argsort(own[0])
        trees[name] = own[0][order], own[1][order]
    return {"langs": langs, "trees": trees, "cut": cut, "costs": _store_costs(counted, cut) if cut else None}


def _store_costs(counted: DataFrame, cut: list[str]) -> str:
    """Store what follows from all paths of the languages ``cut``, each under its number in that
    list; returns where. Only paths that share a context meet, 64 at most."""
    spark = counted.sparkSession
    numbers = spark.createDataFrame(list(enumerate(cut)), "number int, lang string")
    context = F.shiftright("path", BITS)
    paths = counted.join(F.broadcast(numbers), "lang").select("number", "path", "n", context.alias("context"))
    together = Window.partitionBy("number", "context")
    total, kinds = F.sum("n"), F.count(F.lit(1))
    own = F.log2(total.over(together) + kinds.over(together)) - F.log2("n")
    shorter = F.col("path").bitwiseAND(F.lit((1 << BITS * ORDER) - 1)).alias("place")

    def of(kind: int, rows: DataFrame) -> DataFrame:
        return rows.select("number", F.lit(kind).alias("kind"), "place", F.col("value").cast("double").alias("value"))

    found = (
        of(OWN, paths.select("number", F.col("path").alias("place"), own.alias("value")))
        .union(of(ESCAPE, paths.groupBy("number", F.col("context").alias("place")).agg(F.log2((total + kinds) / kinds).alias("value"))))
        .union(of(SHORTER, paths.groupBy("number", shorter).agg(total.alias("value"))))
    )
    folder = scratch_dir(spark, "context-costs")
    found.write.partitionBy("number", "kind").parquet(folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString()


def _read_costs(costs: str, number: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and what is stored of them, by place."""
    store, folder = fs.FileSystem.from_uri(costs)
    rows = pq.read_table(
        f"{folder}/number={number}/kind={kind}", columns=["place", "value"], filesystem=store, partitioning=None
    )
    place, value = (rows.column(c).to_numpy() for c in ("place", "value"))
    order = np.argsort(place)
    return place[order], value[order]


def _level(path: np.ndarray, n: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different paths cut to ``depth`` symbols of context, the bits of each, and those of
    the escape from each context."""
    cut = path & ((1 << BITS * (depth + 1)) - 1)
    short, place = np.unique(cut, return_inverse=True)
    seen = np.bincount(place, n)
    # The symbol is in the low bits, its context above them.
    context = short >> BITS
    size = 1 << BITS * depth
    total = np.bincount(context, seen, minlength=size)
    kinds = np.bincount(context, minlength=size)
    with np.errstate(divide="ignore", invalid="ignore"):
        escape = np.where(total > 0, np.log2((total + kinds) / np.maximum(kinds, 1)), 0.0)
    return short, np.log2(total[context] + kinds[context]) - np.log2(seen), escape


def _lower(path: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Bits of each symbol after each context that is one symbol shorter than the longest,
    whether seen or not."""
    lower = np.full(1 << BITS, float(BITS))
    for depth in range(ORDER):
        short, own, escape = _level(path, n, depth)
        # An unseen symbol: the escape, then its cost one context symbol shorter.
        shorter = np.arange(len(escape) << BITS) & (len(lower) - 1)
        lower = np.repeat(escape, 1 << BITS) + lower[shorter]
        lower[short] = own
    return lower


def _costs(path: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of each kept path, of the escape from each longest context, and of each symbol
    after the context that is one symbol shorter, whether seen or not."""
    _, own, escape = _level(path, n, ORDER)
    return own, escape, _lower(path, n)


def _scorer(model: dict):
    tables: dict = {}

    def costs_of(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs of the paths in memory, and of those not seen."""
        if name not in model["cut"]:
            return _costs(*model["trees"][name])
        number = model["cut"].index(name)
        (path, own), (context, bits), shorter = (_read_costs(model["costs"], number, kind) for kind in (OWN, ESCAPE, SHORTER))
        escape = np.zeros(1 << BITS * ORDER)
        escape[context] = bits
        return own[np.searchsorted(path, model["trees"][name][0])], escape, _lower(*shorter)

    def others(name: str) -> np.ndarray:
        """For every path the cost it has over that of one not seen, if it was seen but is not
        in memory; of one language at a time, as that takes 64**4 numbers."""
        if tables.get("name") != name:
            tables.pop("others", None)
            path, own = _read_costs(model["costs"], model["cut"].index(name), OWN)
            j = model["langs"].index(name)
            more = np.zeros(1 << BITS * (ORDER + 1), np.float32)
            more[path] = own - (tables["rest"][path & tables["low"], j] + tables["escapes"][path >> BITS, j])
            more[model["trees"][name][0]] = 0
            tables.update(name=name, others=more)
        return tables["others"]

    def build() -> None:
        langs, trees = model["langs"], model["trees"]
        known = np.unique(np.concatenate([trees[name][0] for name in langs]))
        costs = [costs_of(name) for name in langs]
        low = (1 << BITS * ORDER) - 1
        rest = np.empty((1 << BITS * ORDER, len(langs)), np.float32)
        escapes = np.empty_like(rest)
        rows = np.empty((len(known), len(langs)), np.float32)
        for j, (own, escape, lower) in enumerate(costs):
            rest[:, j], escapes[:, j] = lower, escape
            rows[:, j] = lower[known & low] + escape[known >> BITS]
            rows[np.searchsorted(known, trees[langs[j]][0]), j] = own
        slot = np.full(1 << BITS * (ORDER + 1), -1, np.int32)
        slot[known] = np.arange(len(known))
        tables.update(rest=rest, escapes=escapes, rows=rows, slot=slot, low=low)

    def bits(path: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        at = tables["slot"][path]
        cost = tables["rows"][at]
        new = np.flatnonzero(at < 0)
        cost[new] = tables["rest"][path[new] & tables["low"]] + tables["escapes"][path[new] >> BITS]
        first = np.searchsorted(owner, np.arange(n + 1))
        total = np.zeros((n, cost.shape[1]))
        some = np.flatnonzero(np.diff(first))
        if len(some):
            total[some] = np.add.reduceat(cost, first[some], axis=0, dtype=np.float64)
        return total

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model["langs"], UNKNOWN], object)
        if model["langs"] and not tables:
            build()
        for batch in batches:
            n = batch.num_rows
            best, share = np.full(n, len(names) - 1), np.zeros(n)
            if model["langs"] and n:
                data, offsets = lx.text_bytes(pc.utf8_lower(batch.column("text")))
                parts = []
                for a, b in lx.pieces(offsets):
                    path, owner = _paths(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    parts.append(bits(path, owner, b - a))
                total = np.concatenate(parts)
                for name in model["cut"]:
                    more, j = others(name), model["langs"].index(name)
                    for a, b in lx.pieces(offsets):
                        path, owner = _paths(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                        total[a:b, j] += np.bincount(owner, more[path], minlength=b - a)
                best = total.argmin(axis=1)
                more = np.minimum(total - total.min(axis=1, keepdims=True), 1000.0)
                share = 1 / np.exp2(-more).sum(axis=1)
                mute = ~batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                best[mute], share[mute] = len(names) - 1, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names[best], pa.string()), pa.array(share, pa.float64())],
                names=["key", "lang_pred", "score"],
            )

    return score


def predict_language(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``lang_pred``, ``score``."""
    kind = docs.schema[key].dataType.simpleString()
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), lettered.alias("lettered"))
    scored = rows.mapInArrow(_scorer(model), f"key {kind}, lang_pred string, score double")
    return scored.select(F.col("key").alias(key), "lang_pred", "score")
