"""Quality rules: counts per text and how much likelier a text is under trusted text.

The verdict is the log-likelihood ratio of two multinomials over hashed word unigrams and
bigrams, one counted over trusted texts and one over all texts, divided by the number of
n-grams. ``BUCKETS`` bounds both models, so they fit in every task at any input size.

Null and empty texts have no words: their counts are 0, their ratio is 0 and they fail
the base rules. Repeated rows are judged one by one. Without trusted texts both
multinomials are flat, all ratios are 0 and the base rules decide alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx

BUCKETS = 1 << 16
#: Texts whose ratio per n-gram is lower are not kept.
LEAST_RATIO = -0.25
#: Added to each bucket's count in units of its share of the raw corpus.
PRIOR_WEIGHT = 5_000.0
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _grams(words: lx.Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the text that each belongs to."""
    owner = lx.owners(words.first)
    at, pairs = words.windows(2)
    hashes = np.concatenate((words.hashes, pairs + np.uint64(1)))
    return (hashes >> np.uint64(48)).astype(np.int64), np.concatenate((owner, owner[at]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, offsets = lx.text_bytes(batch.column("text"))
        is_trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        for a, b in lx.pieces(offsets):
            piece = lx.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            grams, owner = _grams(piece)
            raw += np.bincount(grams, minlength=BUCKETS)
            trusted += np.bincount(grams[is_trusted[a:b][owner]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(raw[seen]), pa.array(trusted[seen])], names=["bucket", "raw", "trusted"]
    )


def fit_ratios(docs: DataFrame, trusted_keys: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """log(target share / raw share) of each bucket.

    Raw counts cover all of ``docs``, trusted ones all that ``trusted_keys`` (one column,
    ``key``) names. The texts are shuffled once for that, at any size: no task and no
    broadcast holds all trusted keys.
    """
    chosen = trusted_keys.select(F.col(key).alias("_key")).dropna().distinct().withColumn("trusted", F.lit(True))
    flagged = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(
        chosen.hint("merge"), "_key", "left"
    )
    flagged = flagged.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = (
        flagged.mapInArrow(_count, "bucket long, raw long, trusted long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
        .toArrow()
    )
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counts.column("bucket").to_numpy()
    raw[at], trusted[at] = counts.column("raw").to_numpy(), counts.column("trusted").to_numpy()
    if not trusted.sum():
        return np.zeros(BUCKETS)
    share = (raw + 1) / (raw.sum() + BUCKETS)
    target = (trusted + PRIOR_WEIGHT * share) / (trusted.sum() + PRIOR_WEIGHT)
    return np.log(target / share)


def _line_repeats(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray, words: lx.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, per text."""
    starts, ends = lx.runs(data != 10, offsets)
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    owner = np.searchsorted(offsets, starts, "right") - 1
    keys = lx.stretch_hashes(sums, starts, ends) ^ lx.mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), np.int64)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return np.bincount(owner, again, minlength=len(offsets) - 1).astype(np.int64)


def _judge(ratios: np.ndarray):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lx.text_bytes(batch.column("text"))
            found = []
            for a, b in lx.pieces(offsets):
                own, places = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words = lx.Words(own, places)
                sums = lx.prefix_hashes(lx.BYTE_VALUES[own])
                words._hashes = lx.stretch_hashes(sums, words.starts, words.ends)
                at, hashes = words.windows(REPEAT_WINDOW)
                owner = lx.owners(words.first)
                twice = at[lx.repeated(hashes ^ lx.mix(owner[at].astype(np.uint64) + np.uint64(1)))]
                in_repeat = lx.covered(twice, twice + REPEAT_WINDOW, len(words.starts))
                grams, gram_owner = _grams(words)
                total = np.bincount(gram_owner, ratios[grams], minlength=b - a)
                n_grams = np.bincount(gram_owner, minlength=b - a)
                inside = lx.NOT_WHITE[own]
                found.append((
                    words.counts,
                    lx.per_text(inside & ((own & 0xC0) != 0x80), places),
                    lx.per_text(SYMBOLS[own], places),
                    _line_repeats(own, places, sums, words),
                    lx.per_text(in_repeat, words.first),
                    total / np.maximum(n_grams, 1),
                ))
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.float64())],
                names=["key", *COUNTS, "ratio"],
            )

    return judge


def judge_texts(docs: DataFrame, ratios: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the counts, ``ratio``, ``base_failed`` and ``kept``."""
    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    judged = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        _judge(ratios), f"key {kind}, {counts}, ratio double"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return judged.select(
        F.col("key").alias(key), *COUNTS, "ratio", failed.alias("base_failed"),
        (~failed & (F.col("ratio") >= LEAST_RATIO)).alias("kept"),
    )
