import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagscope.llm import interpolation as ip
from lagscope.llm import queries

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), None]


def fold_of(key):
    return None if key is None else zlib.crc32(str(key).encode()) % 7


class Plain:
    """The same model, token by token."""

    def __init__(self, docs, order):
        self.order = order
        train = [(k, tokens_of(t)) for k, t in docs if fold_of(k) != 2]
        retained = [t for k, t in train if fold_of(k) != 5]
        deleted = [t for k, t in train if fold_of(k) == 5]
        self.kinds = len({w for _, t in train for w in t})
        self.weights = [[0.5] * 64 for _ in range(order)]
        self.learn(self.count(retained), deleted)
        self.counts = self.count([t for _, t in train])

    def count(self, texts):
        grams = [Counter() for _ in range(self.order + 1)]
        for t in texts:
            padded = ["<s>"] * (self.order - 1) + t
            for i in range(len(t)):
                for k in range(1, self.order + 1):
                    grams[k][tuple(padded[i + self.order - k : i + self.order])] += 1
        return grams, len(texts), sum(map(len, texts))

    def parts(self, counts, padded, i):
        grams, n_texts, n_tokens = counts
        found, p = [], 1 / (self.kinds + 1)
        for k in range(1, self.order + 1):
            gram = tuple(padded[i + self.order - k : i + self.order])
            if k == 1:
                context = n_tokens
            else:
                context = n_texts if i == 0 else grams[k - 1][gram[:-1]]
            b = context.bit_length()
            weight = self.weights[k - 1][b] if context else 0.0
            own = weight * grams[k][gram] / max(context, 1)
            p = own + (1 - weight) * p
            found.append((b, own, p))
        return found

    def learn(self, counts, texts):
        if not texts:
            return
        before = -math.inf
        while True:
            gained, reached, total, n = Counter(), Counter(), 0.0, 0
            for t in texts:
                padded = ["<s>"] * (self.order - 1) + t
                for i in range(len(t)):
                    parts = self.parts(counts, padded, i)
                    total, n, left = total + math.log(parts[-1][2]), n + 1, 1.0
                    for k in range(self.order, 0, -1):
                        b, own, p = parts[k - 1]
                        gained[k, b] += left * own / p
                        reached[k, b] += left
                        left -= left * own / p
            if total / n - before < ip.LEAST_GAIN:
                return
            before = total / n
            for (k, b), x in reached.items():
                if b:
                    self.weights[k - 1][b] = min(round(gained[k, b] / x, 6), ip.MOST_WEIGHT)

    def score(self, key, text):
        t = tokens_of(text)
        padded = ["<s>"] * (self.order - 1) + t
        grams, _, n = self.counts
        score = sum(math.log10(self.parts(self.counts, padded, i)[-1][2]) for i in range(len(t)))
        base = sum(math.log10((grams[1][w,] + 1) / (n + self.kinds + 1)) for w in t)
        return (len(t), sum(grams[1][w,] > 0 for w in t), n, base, score)


def check(df, docs, order):
    model = Plain(docs, order)
    expected = sorted(((k, *model.score(k, t)) for k, t in docs), key=repr)
    found = sorted((tuple(r) for r in df.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=repr)
    assert [f[:4] for f in found] == [e[:4] for e in expected]
    assert np.allclose([f[4:] for f in found], [e[4:] for e in expected], rtol=1e-6)


def sample(n=120):
    random = np.random.default_rng(5)
    words = [f"W{i}" for i in range(40)]
    start = [words[i] for i in random.integers(0, 40, n)]
    docs = []
    for i in range(n):
        w, text = start[i], []
        for _ in range(random.integers(0, 40)):
            text.append(w)
            w = words[(int(w[1:]) * 7 + int(random.integers(0, 3))) % 40]
        docs.append((i, " ".join(text)))
    return [*docs, (500, None), (501, ""), (502, " \t\n"), (3, docs[3][1]), (None, "W1 w2 W3"), (503, "never seen 中文 words")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_a_plain_version(spark, order):
    docs = sample()
    check(ip.score_texts(spark.createDataFrame(docs, "doc_id long, text string"), order), docs, order)


def test_chunks_and_buckets_do_not_show(spark, monkeypatch):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(ip, "CHUNK", 400)
    monkeypatch.setattr(ip, "BUCKET", 100)
    check(ip.score_texts(df), docs, ip.ORDER)


def test_query_beats_single_words(spark, larger_dir):
    rows = queries.deleted_interpolation(spark, larger_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{larger_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    unseen = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in unseen} == {k for k in texts if fold_of(k) == 2}
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
    counts = Counter(w for k, t in texts.items() if fold_of(k) != 2 for w in tokens_of(t))
    n = counts.total()
    for r in rows[:200]:
        t = tokens_of(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in counts for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in t), rel_tol=1e-9)
    again = queries.deleted_interpolation(spark, larger_dir).collect()
    assert sorted(rows) == sorted(again)


def test_probabilities_add_up_to_one():
    """Over all tokens of training and one unseen one, after any context."""
    model = Plain(sample(), 2)
    grams, *_ = model.counts
    words = [w for (w,) in grams[1]]
    for before in ("<s>", "w1", "w39", "unheard"):
        # The position is not a text's first, but for the start mark.
        i = 0 if before == "<s>" else 1
        of = (lambda w: ["<s>", w]) if i == 0 else (lambda w: ["<s>", before, w])
        total = sum(model.parts(model.counts, of(w), i)[-1][2] for w in [*words, "unseen"])
        assert math.isclose(total, 1, rel_tol=1e-6)


def test_numbers_survive_packing():
    for values in ([], [0], [0, 0, 3], [255, 256, 1 << 40], [(1 << 64) - 1, 1]):
        array = np.array(values, np.uint64)
        assert (ip.unpack(ip.pack(array)) == array).all()
        assert (ip.unpack_coded(*ip.pack_coded(array)) == array).all()


def test_odd_rows(odd, nothing):
    rows = ip.score_texts(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in rows)
    assert ip.score_texts(nothing).collect() == []
    only_held_out = odd.withColumn("doc_id", F.lit(next(i for i in range(99) if fold_of(i) == 2)).cast("long"))
    assert {(r["score"], r["base_score"], r["train_tokens"]) for r in ip.score_texts(only_held_out).collect()} == {(0.0, 0.0, 0)}
