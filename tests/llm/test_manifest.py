import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lagscope.llm import manifest, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def tree(hashes):
    """The root, and per leaf its siblings as (hash, stands left)."""
    ways, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for way, i in zip(ways, range(len(hashes)), strict=True):
            other = at[i] ^ 1
            way.append((level[other] if other < len(level) else "", other < at[i]))
            at[i] //= 2
        level = [H(*level[j : j + 2]) for j in range(0, len(level), 2)]
    return level[0], ways


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in groups[name]])
    root, crown = tree([trees[name][0] for name in names])
    found = []
    for name, above in zip(names, crown, strict=True):
        for (_, _, leaf, row), way in zip(groups[name], trees[name][1], strict=True):
            key, hash = row["doc_id"], leaf
            if key is not None and zlib.crc32(str(key).encode()) % 7 == 0 and row["n_chars"] is not None:
                hash = leaf_of({**row, "n_chars": row["n_chars"] + 1})
            for other, left in way + above:
                hash = H(other, hash) if left else H(hash, other)
            proof = H(*(other for other, _ in way + above))
            found.append((key, leaf, trees[name][0], root, proof, hash, hash == root))
    return sorted(found, key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def run(spark, monkeypatch, docs):
    monkeypatch.setattr(queries, "read_table", lambda *_: docs)
    return sorted((tuple(r) for r in queries.merkle_intervals(spark, "").collect()), key=repr)


SMALL = [
    (3, "a", "en", 4, "text"), (1, None, "en", None, ""), (2, "b", None, 5, None), (2, "b", None, 5, None), (9, "", "é", 0, "é"),
    (None, None, None, None, None), (4, "a", "en", 1, "x"), (5, "a", "en", 1, "x"), (6, "a", "en", 1, "x:-"), (2, "b", "en", 5, "other"),
]


@pytest.mark.parametrize("band", [1, 2, 8])
def test_equals_a_plain_version(spark, monkeypatch, band):
    """Whatever the number of levels climbed at once."""
    monkeypatch.setattr(manifest, "BAND", band)
    docs = table(spark, SMALL)
    rows = [r.asDict() for r in docs.collect()]
    found = run(spark, monkeypatch, docs)
    assert found == plain(rows)
    assert {r[0]: r[6] for r in found if r[0] is not None and r[0] not in (1, 2)} == {
        k: zlib.crc32(str(k).encode()) % 7 != 0 for k in (3, 4, 5, 6, 9)
    }


def test_one_group_holds_most_rows(spark, monkeypatch):
    rows = [(i, "s", "en" if i % 10 else f"l{i % 170}", i, f"text {i % 5}") for i in range(1_000)]
    docs = table(spark, rows).repartition(7)
    assert run(spark, monkeypatch, docs) == plain([dict(zip(FIELDS, (r[0], r[1], r[2], r[3], r[4]), strict=True)) for r in rows])


def test_a_lone_row_and_no_row(spark, monkeypatch):
    docs = table(spark, SMALL[:1])
    ((key, leaf, subroot, root, proof, folded, verified),) = run(spark, monkeypatch, docs)
    assert leaf == subroot == root == folded and proof == H("") and verified
    assert run(spark, monkeypatch, docs.limit(0)) == []


def test_odd_rows(odd):
    fields = ["doc_id", "source", "lang", "n", "text"]
    found = manifest.build_manifest(odd, fields)
    checked = found.select("root", manifest.fold(F.col("leaf"), F.col("steps")).alias("folded")).collect()
    assert len(checked) == odd.count()
    assert {r["folded"] for r in checked} == {checked[0]["root"]}


def test_joins_hold_a_row_per_block(spark, sf_dir):
    text = queries.merkle_intervals(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("CartesianProduct", "BroadcastNestedLoop", "Python", "Arrow"))
