"""Language-model scores by deleted interpolation of n-gram estimates.

The maximum-likelihood estimates of orders 1 to ``order`` are mixed, each with the one below it,
down to the uniform distribution:

    p_k(w | context) = lambda_k(b) * c(context w) / c(context) + (1 - lambda_k(b)) * p_(k-1)(w),

where b is the context's frequency, in buckets of powers of two. A part of the training texts,
``DELETED_FOLD``, is held back from the counts, and expectation-maximisation on it finds the
weights. The scores then use the counts of all training texts. A text's tokens are its words,
ASCII letters lower-cased, and one end; before its first word stand start marks, which are
contexts and never predicted.

Texts are cut into chunks of about ``CHUNK`` bytes, stored as numbers of words. A chunk sends its
different n-grams, as sorted 64-bit hashes with their counts, to buckets of hashes; a bucket adds
up and sends back the totals in the order that they came in. So a word that stands in every text
costs one entry per chunk, and a chunk holds the statistics of its own n-grams and no others.
Buckets are as many as keep each at about ``BUCKET`` entries.

Null and empty texts are one token, the end. Rows that repeat are texts of their own; a null key
belongs to no fold, so its text is learned from. Without training texts all scores are 0, as is
the logarithm of the uniform distribution over nothing but an unseen token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx
from lagscope.llm.near import FOLD_CASE
from lagscope.llm.tables import forget, stored

FOLDS = 7
HELD_OUT_FOLD = 2
#: Of the training texts, those that the mixture weights are learned from.
DELETED_FOLD = 5
ORDER = 2
#: Text bytes of a chunk, and entries of a bucket.
CHUNK = 14 << 20
BUCKET = 1 << 21
#: Contexts seen 1, 2-3, 4-7, ... times have weights of their own.
CONTEXT_BUCKETS = 64
#: Steps go on while they gain this much likelihood per token (in nats), so they end.
LEAST_GAIN = 1e-5
MOST_WEIGHT = 0.999999
WEIGHT_DIGITS = 6
RETAINED, DELETED, HELD_OUT = 0, 1, 2
#: A chunk's tokens: its different hashes in order, how often each occurs, and which is where.
TOKENS = ("known", "counts", "ids")

_END, _START = lx.mix(np.array([0x656E64, 0x7374617274], np.uint64))


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def held_out(key: Column) -> Column:
    """True for the texts that are not learned from; a null key belongs to no fold."""
    return F.coalesce(fold(key) == HELD_OUT_FOLD, F.lit(False))


# --- arrays of whole numbers as bytes ------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0, byte by byte of equal rank, compressed."""
    values = np.ascontiguousarray(values, np.uint64)
    wide = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.view(np.uint8).reshape(-1, 8).T[:wide].tobytes()
    head = bytes([wide]) + len(values).to_bytes(8, "little")
    return head + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpack(body: bytes) -> np.ndarray:
    wide, n = body[0], int.from_bytes(body[1:9], "little")
    values = np.zeros((n, 8), np.uint8)
    if wide and n:
        planes = np.frombuffer(pa.decompress(body[9:], wide * n, "zstd"), np.uint8)
        values[:, :wide] = planes.reshape(wide, n).T
    return values.view(np.uint64).ravel()


def by_frequency(counts: np.ndarray) -> np.ndarray:
    """The places of some values, the most frequent first: numbered so, frequent ones have
    small numbers, whose higher bytes compress to nothing."""
    return np.argsort(-counts.astype(np.int64), kind="stable")


def pack_coded(values: np.ndarray) -> list[bytes]:
    """Numbers of few different values: the values, the most frequent first, and which is where."""
    known, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    order = by_frequency(counts)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return [pack(known[order]), pack(place[at])]


def unpack_coded(known: bytes, at: bytes) -> np.ndarray:
    return unpack(known)[unpack(at).astype(np.int64)]


# --- chunks --------------------------------------------------------------------------------


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and their number per text. Words are hashed a piece at a time, so
    that the running sums stay small."""
    parts, counts = [], []
    for a, b in lx.pieces(offsets):
        words = lx.Words(FOLD_CASE[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a])
        hashes = np.full(len(words.starts) + b - a, _END, np.uint64)
        hashes[np.arange(len(words.starts)) + lx.owners(words.first)] = words.hashes
        parts.append(hashes)
        counts.append(words.counts + 1)
    return np.concatenate(parts), np.concatenate(counts)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context, made = TaskContext.get(), 0
    base = (context.partitionId() if context else 0) << 33
    for batch in batches:
        data, offsets = lx.text_bytes(batch.column("text"))
        part = batch.column("part").to_numpy()
        for a, b in lx.pieces(offsets, CHUNK):
            hashes, n = _tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            known, at, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            order = by_frequency(counts)
            ids = np.empty_like(order)
            ids[order] = np.arange(len(order))
            own = part[a:b]
            sums = [int(n[own == p].sum()) for p in (RETAINED, DELETED, HELD_OUT)]
            numbers = [base + made, *sums, int((own == RETAINED).sum()), int((own == DELETED).sum())]
            lists = [
                pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), column)
                for column in (batch.column("key").slice(a, b - a), pa.array(own, pa.int32()), pa.array(n, pa.int64()))
            ]
            bodies = (np.diff(known, prepend=np.uint64(0)), counts, ids[at])
            blobs = [pa.array([pack(x)], pa.binary()) for x in bodies]
            names = ["chunk", "n_retained", "n_deleted", "n_held", "texts_retained", "texts_deleted", "keys", "part", "n", *TOKENS]
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in numbers), *lists, *blobs], names=names)
            made += 1


class _Chunk:
    """The tokens of a chunk: hashes of their n-grams, and the part of its text."""

    def __init__(self, known: bytes, counts: bytes, ids: bytes, n: np.ndarray, part: np.ndarray):
        self.n, self.part = n, part
        hashes = np.cumsum(unpack(known), dtype=np.uint64)[by_frequency(unpack(counts))]
        self.tokens = hashes[unpack(ids).astype(np.int64)]
        self.first = np.cumsum(n) - n
        self.owner_part = np.repeat(part, n)

    def grams(self, order: int) -> Iterator[np.ndarray]:
        """Per order the hash of the n-gram that ends at each token."""
        gram, before = self.tokens, _START
        yield gram
        for k in range(2, order + 1):
            context = np.empty_like(gram)
            context[1:] = gram[:-1]
            context[self.first] = before
            before = lx.mix(np.array([before]) * np.uint64(lx.BASE) + _START + np.uint64(k))[0]
            gram = lx.mix(context * np.uint64(lx.BASE) + self.tokens + np.uint64(k))
            yield gram

    def contexts(self, counts: np.ndarray, texts: int) -> np.ndarray:
        """How often each token's context occurs, from the counts one order below."""
        found = np.empty_like(counts)
        found[1:] = counts[:-1]
        found[self.first] = texts
        return found


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Chunk]]:
    for batch in batches:
        for i in range(batch.num_rows):
            bodies = (batch.column(c)[i].as_py() for c in TOKENS)
            n, part = (batch.column(c)[i].values.to_numpy() for c in ("n", "part"))
            yield batch.column("chunk")[i].as_py(), _Chunk(*bodies, n, part)


def _buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where in the sorted hashes each bucket, of equal leading bits, begins; and the end."""
    if not bits:
        return np.array([0, len(hashes)])
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(hashes, starts), len(hashes))


def _send(order: int, bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, chunk in _chunks_of(batches):
            for k, grams in enumerate(chunk.grams(order), 1):
                hashes, at = np.unique(grams, return_inverse=True)
                counts = [np.bincount(at[chunk.owner_part == p], minlength=len(hashes)) for p in (RETAINED, DELETED)]
                borders = _buckets(hashes, bits)
                filled = np.flatnonzero(np.diff(borders))
                spans = [slice(borders[j], borders[j + 1]) for j in filled]
                bodies = [[pack(np.diff(hashes[s], prepend=np.uint64(0))) for s in spans]]
                bodies += [[pack(c[s]) for s in spans] for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k] * len(spans), pa.int32()), pa.array(filled, pa.int64()),
                        pa.array([name] * len(spans), pa.int64()), *(pa.array(x, pa.binary()) for x in bodies),
                    ],
                    names=["gram_order", "bucket", "chunk", "hashes", "retained", "deleted"],
                )

    return send


SENT = "gram_order int, bucket long, chunk long, hashes binary, retained binary, deleted binary"
BACK = "gram_order int, bucket long, chunk long, retained binary, deleted binary, kinds long"


def _add_up(sent: pa.Table) -> pa.Table:
    """One bucket: the totals of its n-grams, to each chunk in its own order. The first row
    also says how many different ones the training texts hold."""
    hashes = [np.cumsum(unpack(x), dtype=np.uint64) for x in sent.column("hashes").to_pylist()]
    ends = np.cumsum([len(x) for x in hashes])[:-1]
    known, at = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = []
    for name in ("retained", "deleted"):
        counts = np.concatenate([unpack(x) for x in sent.column(name).to_pylist()])
        # Doubles add whole numbers up to 2**53 without loss.
        totals.append(np.bincount(at, counts, minlength=len(known)).astype(np.uint64))
    kinds = np.zeros(sent.num_rows, np.int64)
    kinds[0] = np.count_nonzero(totals[0] + totals[1])
    bodies = [[pack(x) for x in np.split(t[at], ends)] for t in totals]
    return pa.table(
        [*(sent.column(c) for c in ("gram_order", "bucket", "chunk")), *(pa.array(x, pa.binary()) for x in bodies), pa.array(kinds)],
        names=["gram_order", "bucket", "chunk", "retained", "deleted", "kinds"],
    )


def _alike(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different columns, and how often each occurs."""
    ordered = columns[:, np.lexsort(columns)]
    new = np.ones(ordered.shape[1], bool)
    new[1:] = (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return ordered[:, first], np.diff(np.append(first, len(new)))


def _resolve(order: int):
    """A chunk and the totals of its n-grams: per token the counts of all training texts, and
    for tokens of deleted texts, equal ones together, the counts of the retained ones."""

    def resolve(chunks: pa.Table, back: pa.Table) -> pa.Table:
        _, chunk = next(_chunks_of(iter(chunks.combine_chunks().to_batches())))
        trained, evidence = [], []
        deleted = chunk.owner_part == DELETED
        starts = np.zeros(len(deleted), bool)
        starts[chunk.first] = True
        kinds, below = 0, None
        for k, grams in enumerate(chunk.grams(order), 1):
            own = back.filter(pc.equal(back.column("gram_order"), k)).sort_by("bucket")
            _, at = np.unique(grams, return_inverse=True)
            retained, others = (np.concatenate([unpack(x) for x in own.column(c).to_pylist()])[at] for c in ("retained", "deleted"))
            trained += pack_coded(retained + others)
            kinds += sum(own.column("kinds").to_pylist()) if k == 1 else 0
            if k > 1:
                evidence.append(chunk.contexts(below, 0)[deleted])
            evidence.append(retained[deleted])
            below = retained
        evidence.append(starts[deleted])
        rows, often = _alike(np.array(evidence, np.uint64))
        return pa.table(
            [
                *(chunks.column(c) for c in ("keys", "n")), pa.array([trained], pa.list_(pa.binary())),
                pa.array([[pack(x) for x in [*rows, often]]], pa.list_(pa.binary())), pa.array([kinds], pa.int64()),
            ],
            names=["keys", "n", "trained", "evidence", "kinds"],
        )

    return resolve


# --- mixture weights ------------------------------------------------------------------------


@dataclass(frozen=True)
class Mixture:
    """Sizes of the training texts, and the weight of each order in each bucket of contexts."""

    order: int
    n_tokens: int
    n_texts: int
    n_kinds: int
    weights: np.ndarray


def _bucket_of(context: np.ndarray) -> np.ndarray:
    return np.frexp(context.astype(np.float64))[1]


def _estimates(counts: list[np.ndarray], contexts: list[np.ndarray], mixture: Mixture) -> list[tuple]:
    """From order 1 up: bucket, weighted estimate, and the mixture up to that order."""
    found, p = [], np.full(len(counts[0]), 1.0 / (mixture.n_kinds + 1))
    for k, (count, context) in enumerate(zip(counts, contexts, strict=True)):
        bucket = _bucket_of(context)
        weight = np.where(context > 0, mixture.weights[k][bucket], 0.0)
        own = weight * count / np.maximum(context, 1)
        p = own + (1 - weight) * p
        found.append((bucket, own, p))
    return found


def _read(bodies: list[bytes], mixture: Mixture) -> tuple[list, list, np.ndarray]:
    """Counts and contexts of each order, and how often, from a chunk's evidence."""
    *columns, starts, often = (unpack(x).astype(np.int64) for x in bodies)
    # Before a text's first token stand the start marks, once per text.
    contexts = [np.full(len(often), mixture.n_tokens)]
    contexts += [np.where(starts == 1, mixture.n_texts, c) for c in columns[1::2]]
    return [columns[0], *columns[2::2]], contexts, often


def _step(mixture: Mixture):
    """Expectations under the present weights, added up per order and bucket; the likelihood
    is order 0."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained, reached = (np.zeros((mixture.order + 1, CONTEXT_BUCKETS)) for _ in range(2))
        for batch in batches:
            for bodies in batch.column("evidence").to_pylist():
                counts, contexts, often = _read(bodies, mixture)
                found = _estimates(counts, contexts, mixture)
                left = often.astype(np.float64)
                gained[0, 0] += (left * np.log(found[-1][2])).sum()
                reached[0, 0] += left.sum()
                for k in range(mixture.order, 0, -1):
                    bucket, own, p = found[k - 1]
                    share = left * own / p
                    gained[k] += np.bincount(bucket, share, minlength=CONTEXT_BUCKETS)
                    reached[k] += np.bincount(bucket, left, minlength=CONTEXT_BUCKETS)
                    left = left - share
        k, bucket = np.nonzero(reached)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(bucket, pa.int32()), pa.array(gained[k, bucket]), pa.array(reached[k, bucket])],
            names=["gram_order", "bucket", "gained", "reached"],
        )

    return expect


def learn_weights(evidence: DataFrame, start: Mixture) -> Mixture:
    """Expectation-maximisation: every step reads the evidence where it lies and brings back a
    row per order and bucket."""
    weights, before = start.weights, -np.inf
    while True:
        mixture = Mixture(start.order, start.n_tokens, start.n_texts, start.n_kinds, weights)
        sums = (
            evidence.mapInArrow(_step(mixture), "gram_order int, bucket int, gained double, reached double")
            .groupBy("gram_order", "bucket")
            .agg(F.sum("gained").alias("gained"), F.sum("reached").alias("reached"))
            .collect()
        )
        likelihood = next((r["gained"] / r["reached"] for r in sums if r["gram_order"] == 0), before)
        if likelihood - before < LEAST_GAIN or not np.isfinite(likelihood):
            return mixture
        weights, before = weights.copy(), likelihood
        for r in sums:
            if r["gram_order"] and r["bucket"]:
                # Rounded, so that the order in which tasks add up does not show.
                weight = round(r["gained"] / r["reached"], WEIGHT_DIGITS)
                weights[r["gram_order"] - 1][r["bucket"]] = min(weight, MOST_WEIGHT)


# --- scores ---------------------------------------------------------------------------------


def _score(mixture: Mixture):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_all, kinds = mixture.n_tokens, mixture.n_kinds
        for batch in batches:
            for i in range(batch.num_rows):
                keys, n = batch.column("keys")[i].values, batch.column("n")[i].values.to_numpy()
                bodies = batch.column("trained")[i].as_py()
                counts = [unpack_coded(*pair).astype(np.int64) for pair in zip(bodies[::2], bodies[1::2], strict=True)]
                first = np.cumsum(n) - n
                contexts = [np.full(len(counts[0]), n_all)]
                for below in counts[:-1]:
                    context = np.concatenate(([0], below[:-1]))
                    context[first] = mixture.n_texts
                    contexts.append(context)
                p = _estimates(counts, contexts, mixture)[-1][2]
                base = np.log10((counts[0] + 1) / (n_all + kinds + 1))
                known = np.add.reduceat((counts[0] > 0).astype(np.int64), first)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(n), pa.array(known), pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(np.log10(p), first))],
                    names=["key", "n_tokens", "n_known", "base_score", "score"],
                )

    return score


def score_texts(docs: DataFrame, order: int = ORDER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-one unigrams) and ``score``, both log10."""
    kind = docs.schema[key].dataType.simpleString()
    of = fold(F.col(key))
    part = F.when(of == HELD_OUT_FOLD, HELD_OUT).when(of == DELETED_FOLD, DELETED).otherwise(RETAINED)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), part.cast("int").alias("part"))
    numbers = ["chunk", "n_retained", "n_deleted", "n_held", "texts_retained", "texts_deleted"]
    schema = f"{', '.join(f'{c} long' for c in numbers)}, keys array<{kind}>, part array<int>, n array<long>, {', '.join(f'{c} binary' for c in TOKENS)}"
    chunks = stored(rows.mapInArrow(_cut, schema), "lm-chunks")
    totals = chunks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers[1:])).first()
    trained = totals["n_retained"] + totals["n_deleted"]
    bits = max((trained + totals["n_held"] - 1) // BUCKET, 0).bit_length()
    sent = chunks.select("chunk", "n", "part", *TOKENS).mapInArrow(_send(order, bits), SENT)
    back = sent.groupBy("gram_order", "bucket").applyInArrow(_add_up, BACK)
    counted = stored(
        chunks.select("chunk", "keys", "part", "n", *TOKENS).groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
            _resolve(order), f"keys array<{kind}>, n array<long>, trained array<binary>, evidence array<binary>, kinds long"
        ),
        "lm-counted",
    )
    forget(chunks)
    n_kinds = counted.agg(F.sum("kinds")).first()[0] or 0
    halves = np.full((order, CONTEXT_BUCKETS), 0.5)
    start = Mixture(order, totals["n_retained"], totals["texts_retained"], n_kinds, halves)
    learned = learn_weights(counted.select("evidence"), start)
    mixture = Mixture(order, trained, totals["texts_retained"] + totals["texts_deleted"], n_kinds, learned.weights)
    scored = counted.select("keys", "n", "trained").mapInArrow(
        _score(mixture), f"key {kind}, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        F.col("key").alias(key), "n_tokens", "n_known", F.lit(trained).cast("long").alias("train_tokens"), "base_score", "score"
    )
