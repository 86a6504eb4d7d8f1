"""Toxicity: a linear-chain conditional random field over the words of a text.

Labels name whole texts, so tokens are labelled from them: a word of a toxic text is
toxic where toxic texts use the word far more often than clean ones (``TOXIC_EVIDENCE``).
Words are lower-cased runs of letters, hashed to ``BUCKETS``; a bucket's evidence is the
smoothed log ratio of the shares of toxic and of clean texts that hold it, and the field
sees it as one of a few steps. The field has two states (clean, toxic), one weight per
state and step, and one per pair of neighbouring states. Its forward-backward marginals
give each word a probability; a text's score is a logistic function of the expected
number of toxic words, their share and the largest marginal.

The classifier is fitted on at most ``MOST_LABELLED`` rows of each label, picked by a hash
of their key, the field on ``MOST_SEQUENCES`` of them. Every text is one chain, however
long. It is worked on in blocks of ``BLOCK`` words at a time, and the messages that pass
from block to block follow from the product of each block's matrices: the size of a block
changes no marginal.

Null and empty texts have no words and get the score of a text without toxic words. A
key that repeats in the labels counts once, as toxic if any of its labels is. Without toxic
or without clean labels every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx

BUCKETS = 1 << 18
MOST_LABELLED = 10_000
MOST_SEQUENCES = 1_000
PRIOR = 2.0
STEPS = np.array([0.5, 0.9, 1.2, 1.5, 1.9, 2.3, 2.8, 3.4])
TOXIC_EVIDENCE = 1.2
BLOCK = 64
ROUNDS = 60
THRESHOLD = 0.3
#: A word is reported as an offending span from this marginal on.
SPAN_MARGINAL = 0.5


def _words(data: np.ndarray, offsets: np.ndarray, a: int, b: int) -> tuple[lx.Words, np.ndarray]:
    words = lx.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lx.LETTERS)
    return words, (words.hashes >> np.uint64(46)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each label a bucket occurs."""
    n = np.zeros((2, BUCKETS), np.int64)
    texts = np.zeros(2, np.int64)
    for batch in batches:
        data, offsets = lx.text_bytes(pc.utf8_lower(batch.column("text")))
        label = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        texts += np.bincount(label, minlength=2)
        for a, b in lx.pieces(offsets):
            words, bucket = _words(data, offsets, a, b)
            pair = np.unique(lx.owners(words.first) * BUCKETS + bucket)
            for value in (0, 1):
                own = label[a:b][pair // BUCKETS] == value
                n[value] += np.bincount(pair[own] % BUCKETS, minlength=BUCKETS)
    seen = np.flatnonzero(n.sum(axis=0))
    # Bucket -1 holds the number of texts.
    columns = [np.append(seen, -1), np.append(n[0][seen], texts[0]), np.append(n[1][seen], texts[1])]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "clean", "toxic"])


def _steps_of(evidence: np.ndarray):
    steps = np.searchsorted(STEPS, evidence, "right").astype(np.uint8)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lx.text_bytes(pc.utf8_lower(batch.column("text")))
            found = []
            for a, b in lx.pieces(offsets):
                words, bucket = _words(data, offsets, a, b)
                own = steps[bucket]
                found += [own[x:y].tobytes() for x, y in zip(words.first[:-1], words.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.binary())], names=["toxic", "steps"]
            )

    return sequences


def blocks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of blocks of up to ``BLOCK`` words that do not cross texts, and which
    of its text's blocks each is."""
    sizes = np.diff(first)
    n = -(-sizes // BLOCK)
    which = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    starts = first[which] + nth * BLOCK
    return starts, np.minimum(sizes[which] - nth * BLOCK, BLOCK), nth


def _live(sizes: np.ndarray) -> list[int]:
    """Of blocks by falling size, how many are longer than 0, 1, 2 and so on."""
    return [int(np.searchsorted(-sizes, -t, "left")) for t in range(int(sizes[0]) if len(sizes) else 0)]


def _messages(
    potential: np.ndarray, step: np.ndarray, starts: np.ndarray, sizes: np.ndarray, nth: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For blocks by text and place, what the words before say of the state before the block,
    and what those behind say of its last state; each up to a factor."""
    before, behind = np.ones((len(starts), 2)), np.ones((len(starts), 2))
    follows = np.flatnonzero(nth)
    if not len(follows):
        return before, behind
    of_long = np.union1d(follows, follows - 1)
    of_long = of_long[np.argsort(-sizes[of_long], kind="stable")]
    through = np.zeros((len(of_long), 2, 2))
    for t, k in enumerate(_live(sizes[of_long])):
        at = potential[starts[of_long[:k]] + t][:, None, :]
        now = np.eye(2) * at if t == 0 else (through[:k].reshape(-1, 2) @ step).reshape(-1, 2, 2) * at
        through[:k] = now / now.sum(axis=(1, 2), keepdims=True)
    whole = np.empty((len(starts), 2, 2))
    whole[of_long] = through
    by_place = follows[np.argsort(nth[follows], kind="stable")]
    ends = np.cumsum(np.bincount(nth[by_place]))
    places = [by_place[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    for at in places:
        # The first block of a text has no state before it.
        enters = before[at - 1] @ step if nth[at[0]] > 1 else before[at - 1]
        leaves = (enters[:, :, None] * whole[at - 1]).sum(axis=1)
        before[at] = leaves / leaves.sum(axis=1, keepdims=True)
    for at in reversed(places):
        leaves = (whole[at] * behind[at][:, None, :]).sum(axis=2) @ step.T
        behind[at - 1] = leaves / leaves.sum(axis=1, keepdims=True)
    return before, behind


def marginals(emission: np.ndarray, move: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(toxic) of each word by forward-backward, the expected number of each pair of
    neighbouring states, and the log partition sum.

    ``emission`` (words, 2) and ``move`` (2, 2) are log potentials, ``first`` the first word
    of each text, which is one chain. All blocks advance together, one word at a time.
    """
    starts, sizes, nth = blocks(first)
    potential, step = np.exp(emission), np.exp(move)
    before, behind = _messages(potential, step, starts, sizes, nth)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, before, behind = starts[order], sizes[order], before[order], behind[order]
    follows = nth[order] > 0
    enters = np.where(follows[:, None], before @ step, 1.0)
    live = _live(sizes)
    longest = len(live)
    forward = np.empty((longest, len(starts), 2))
    scale = np.ones((longest, len(starts)))
    for t in range(longest):
        k = live[t]
        now = (enters if t == 0 else forward[t - 1, :k] @ step) * potential[starts[:k] + t]
        scale[t, :k] = now.sum(axis=1)
        forward[t, :k] = now / scale[t, :k, None]
    toxic = np.zeros(len(emission))
    pairs = np.zeros((2, 2))
    last = forward[sizes - 1, np.arange(len(starts))] if longest else behind
    back = behind / (last * behind).sum(axis=1, keepdims=True)
    for t in range(longest - 1, -1, -1):
        k = live[t]
        both = forward[t, :k] * back[:k]
        both /= both.sum(axis=1, keepdims=True)
        toxic[starts[:k] + t] = both[:, 1]
        ahead = potential[starts[:k] + t] * back[:k] / scale[t, :k, None]
        if t:
            pairs += step * (forward[t - 1, :k].T @ ahead)
            back[:k] = ahead @ step.T
        else:
            pairs += step * (before[follows].T @ ahead[follows])
    return toxic, pairs, float(np.log(scale).sum())


def fit_field(steps: np.ndarray, label: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights that make the labels of the tokens likeliest (resilient gradient ascent)."""
    n = len(STEPS) + 1
    linked = np.ones(len(steps), bool)
    linked[first[:-1][np.diff(first) > 0]] = False
    seen = np.zeros((n, 2))
    np.add.at(seen, (steps, label), 1)
    seen_pairs = np.zeros((2, 2))
    at = np.flatnonzero(linked)
    np.add.at(seen_pairs, (label[at - 1], label[at]), 1)
    weights, rate, last = np.zeros(2 * n + 4), np.full(2 * n + 4, 0.3), np.zeros(2 * n + 4)
    for _ in range(ROUNDS):
        emit, move = weights[: 2 * n].reshape(n, 2), weights[2 * n :].reshape(2, 2)
        toxic, pairs, _ = marginals(emit[steps], move, first)
        expected = np.bincount(steps, toxic, minlength=n)
        total = np.bincount(steps, minlength=n)
        slope = np.concatenate((
            (seen - np.stack((total - expected, expected), axis=1)).ravel(), (seen_pairs - pairs).ravel(),
        )) - 0.5 * weights
        agree = slope * last
        rate = np.clip(np.where(agree > 0, rate * 1.2, np.where(agree < 0, rate * 0.5, rate)), 1e-4, 1.0)
        slope[agree < 0] = 0
        weights += np.sign(slope) * rate
        last = slope
    return weights[: 2 * n].reshape(n, 2), weights[2 * n :].reshape(2, 2)


def _features(toxic: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What the logistic score sees of each text."""
    expected = lx.per_text(toxic, first)
    sizes = np.diff(first)
    largest = np.zeros(len(sizes))
    some = np.flatnonzero(sizes)
    if len(some):
        largest[some] = np.maximum.reduceat(toxic, first[some])
    return np.stack((np.ones(len(sizes)), np.log1p(expected), np.sqrt(expected / np.maximum(sizes, 1)), largest), 1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps with a small penalty."""
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 0.1 * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(bend, slope), -3, 3)
    return beta


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> dict | None:
    """Learn from the texts of ``docs`` whose key ``labels`` marks 0 or 1; None without both."""
    marked = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("toxic")).dropna()
        .groupBy("_key").agg(F.max("toxic").alias("toxic")).filter(F.col("toxic").isin(0, 1))
    )
    order = [F.xxhash64("_key"), F.col("_key")]

    def some(n: int) -> DataFrame:
        parts = [marked.filter(F.col("toxic") == value).orderBy(*order).limit(n) for value in (0, 1)]
        return parts[0].unionAll(parts[1])

    def texts(n: int) -> DataFrame:
        rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).filter(F.col(text).isNotNull())
        return rows.join(F.broadcast(some(n)), "_key").select("text", "toxic")

    counts = (
        texts(MOST_LABELLED).mapInArrow(_count, "bucket long, clean long, toxic long")
        .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    )
    at = counts.column("bucket").to_numpy()
    clean, toxic = counts.column("clean").to_numpy(), counts.column("toxic").to_numpy()
    n_clean, n_toxic = int(clean[at < 0].sum()), int(toxic[at < 0].sum())
    if not n_clean or not n_toxic:
        return None
    evidence = np.zeros(BUCKETS)
    real = at >= 0
    shares = (toxic + PRIOR) / (n_toxic + 2 * PRIOR), (clean + PRIOR) / (n_clean + 2 * PRIOR)
    # A word that neither label has seen says nothing.
    nothing = np.log(PRIOR / (n_toxic + 2 * PRIOR)) - np.log(PRIOR / (n_clean + 2 * PRIOR))
    evidence[at[real]] = (np.log(shares[0]) - np.log(shares[1]) - max(nothing, 0))[real]
    rows = texts(MOST_SEQUENCES).mapInArrow(_steps_of(evidence), "toxic int, steps binary").toArrow()
    is_toxic = rows.column("toxic").to_numpy().astype(np.int64)
    parts = [np.frombuffer(s, np.uint8) for s in rows.column("steps").to_pylist()]
    # The same weights whatever order the tasks answer in.
    by_content = sorted(range(len(parts)), key=lambda i: (is_toxic[i], parts[i].tobytes()))
    parts, is_toxic = [parts[i] for i in by_content], is_toxic[by_content]
    first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    steps = np.concatenate(parts).astype(np.int64)
    token_label = (steps >= np.searchsorted(STEPS, TOXIC_EVIDENCE, "right")) & (is_toxic[lx.owners(first)] == 1)
    emit, move = fit_field(steps, token_label.astype(np.int64), first)
    of_text = _features(marginals(emit[steps], move, first)[0], first)
    # Each label weighs as it does among all labels that were counted.
    share = {0: n_clean / max((is_toxic == 0).sum(), 1), 1: n_toxic / max((is_toxic == 1).sum(), 1)}
    weight = np.where(is_toxic == 1, share[1], share[0]) * len(is_toxic) / (n_clean + n_toxic)
    beta = _logistic(of_text, is_toxic, weight)
    lx.give_back()
    return {"evidence": evidence.astype(np.float32), "emit": emit, "move": move, "beta": beta}


def _scorer(model: dict):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.searchsorted(STEPS, model["evidence"], "right").astype(np.uint8)
        for batch in batches:
            data, offsets = lx.text_bytes(pc.utf8_lower(batch.column("text")))
            scores, spans = [], []
            for a, b in lx.pieces(offsets):
                words, bucket = _words(data, offsets, a, b)
                toxic, _, _ = marginals(model["emit"][steps[bucket]], model["move"], words.first)
                of_text = _features(toxic, words.first)
                scores.append(1 / (1 + np.exp(-np.clip(of_text @ model["beta"], -30, 30))))
                hit = lx.owners(words.first)
                starts, ends = lx.runs(toxic >= SPAN_MARGINAL, words.first)
                held: list[list] = [[] for _ in range(b - a)]
                for x, y in zip(starts, ends, strict=True):
                    base = words.offsets[hit[x]]
                    own = words.data[base : words.ends[y - 1]]
                    begin = int(((own[: words.starts[x] - base] & 0xC0) != 0x80).sum())
                    held[hit[x]].append({"start": begin, "end": int(((own & 0xC0) != 0x80).sum())})
                spans += held
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.concatenate(scores) if scores else [], pa.float64()), pa.array(spans, kind)],
                names=["key", "score", "toxic_spans"],
            )

    return lx.tidy(score)


def score_toxicity(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``score``, ``predicted`` and ``toxic_spans``, the
    offending stretches of words as code points of the lower-cased text, end exclusive."""
    kind = docs.schema[key].dataType.simpleString()
    spans = "array<struct<start:bigint,end:bigint>>"
    if model is None:
        scored = docs.select(
            F.col(key).alias("key"), F.lit(0.0).alias("score"), F.array().cast(spans).alias("toxic_spans")
        )
    else:
        rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        scored = rows.mapInArrow(_scorer(model), f"key {kind}, score double, toxic_spans {spans}")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select(F.col("key").alias(key), "score", predicted, "toxic_spans")


def keep_civil(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    if model is None:
        return docs
    inner = _scorer(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays(
                [pa.nulls(batch.num_rows), batch.column(text)], names=["key", "text"]
            )
            (scored,) = inner(iter([own]))
            yield batch.filter(pc.less(scored.column("score"), THRESHOLD))

    return docs.mapInArrow(lx.tidy(keep), docs.schema)
