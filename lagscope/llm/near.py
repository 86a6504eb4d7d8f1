"""Near-duplicates: MinHash with tensored banding, links confirmed on full sets.

A document's set holds its distinct shingles of words (ASCII letters lower-cased). Two
collections of ``GROUPS`` hash groups are made, of ``HASHES`` minhashes each; every pair
of a group of the first and one of the second is the key of one table, so GROUPS**2
tables cost 2 * GROUPS * HASHES minhashes. Two documents meet in a table where both
halves of its key agree. At a similarity of 0.8 the chance that they meet in none is
2 * (1 - 0.8**HASHES)**GROUPS = 0.04 %, and far less above.

Documents with equal sets are one class from the start, found by a 128-bit digest of the
set; only classes are compared. Half keys that no other class shares are dropped before
the tables are formed, since their tables hold nobody else.

Within a bucket not all pairs are compared, only enough to know the components. First
each class meets one pivot, the class of its buckets whose half keys most others share;
that joins the copies of a text to it. Buckets whose classes are then in one component are
finished. In the others every class outside the bucket's largest component meets the
members of other components, in the first of the tables that they share, unless the two
provably cannot be linked. Linked sets differ in few shingles, and every set has a parity
signature: each shingle flips one of ``PARITY_BITS`` bits. Two signatures never differ in
more bits than the sets in shingles, so a pair whose signatures differ in too many is no
link and is not made. Every other pair that shares a table is confirmed.

Null texts and texts without words have an empty set: they are linked with nothing and
their own component. Rows that repeat a key stay rows of their own; ``component_id`` is
the smallest key of a component, nulls apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagscope.llm import lexing as lx
from lagscope.llm.tables import decided, forget, row_names, stored

GROUPS = 12
HASHES = 3
PARITY_BITS = 1024
PERCENT = 80
SHINGLE = 5
#: Bytes kept of each shingle's hash in a stored set: two different shingles of a pair of
#: documents with 10,000 each agree with a chance below 1 in 5,000.
SET_BYTES = 5
FOLD_CASE = np.arange(256, dtype=np.uint8)
FOLD_CASE[0x41:0x5B] += 32
_MULTIPLIERS = lx.mix(np.arange(1000, 1000 + 2 * GROUPS * HASHES, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = lx.mix(np.arange(5000, 5000 + 2 * GROUPS * HASHES, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, and the first of each text."""
    words = lx.Words(FOLD_CASE[data], offsets)
    at, hashes = words.windows(size)
    owner = lx.owners(words.first)[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        # Too few words: all of them are one shingle, told apart from others by its length.
        sums = lx.prefix_hashes(words.hashes)
        whole = lx.stretch_hashes(sums, words.first[short], words.first[short + 1])
        hashes = np.concatenate((hashes, whole ^ lx.mix(words.counts[short].astype(np.uint64))))
        owner = np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    again = np.flatnonzero(lx.repeated(hashes ^ lx.mix(owner.astype(np.uint64) + np.uint64(1))))
    if len(again):
        order = again[np.lexsort((hashes[again], owner[again]))]
        same = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        keep = np.ones(len(hashes), bool)
        keep[order[1:][same]] = False
        hashes, owner = hashes[keep], owner[keep]
    return hashes, np.searchsorted(owner, np.arange(len(offsets)))


def half_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each nonempty set its 2 * GROUPS half keys."""
    begin = first[:-1][np.diff(first) > 0]
    keys = np.zeros((len(begin), 2 * GROUPS), np.uint64)
    if len(begin):
        for i, (by, plus) in enumerate(zip(_MULTIPLIERS, _OFFSETS, strict=True)):
            lowest = np.minimum.reduceat(hashes * by + plus, begin)
            keys[:, i // HASHES] = lx.mix(keys[:, i // HASHES] + lowest)
    return keys


def _digests(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bytes of each set, the same whatever the order of its shingles."""
    sums = [np.zeros(len(hashes) + 1, np.uint64) for _ in range(2)]
    np.cumsum(hashes, out=sums[0][1:])
    np.cumsum(lx.mix(hashes ^ np.uint64(0xD16E57)), out=sums[1][1:])
    sums = [s[first[1:]] - s[first[:-1]] for s in sums]
    return np.stack((lx.mix(sums[0]), lx.mix(sums[1] + sums[0])), axis=1)


def parities(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The parity signature of each set, as words of 64 bits."""
    out = np.zeros((len(first) - 1, PARITY_BITS // 64), np.uint64)
    bit = (hashes >> np.uint64(64 - PARITY_BITS.bit_length() + 1)).astype(np.int64)
    for a in range(0, len(out), 1024):
        b = min(a + 1024, len(out))
        own = slice(first[a], first[b])
        owner = np.repeat(np.arange(b - a), np.diff(first[a : b + 1]))
        odd = np.bincount(owner * PARITY_BITS + bit[own], minlength=(b - a) * PARITY_BITS) & 1
        out[a:b] = np.packbits(odd.astype(np.uint8)).view(np.uint64).reshape(b - a, -1)
    return out


def _signer(size: int):
    width = PARITY_BITS // 64

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lx.text_bytes(batch.column("text"))
            sizes, sets, keys, signs = [], [], [], []
            for a, b in lx.pieces(offsets):
                hashes, first = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                n = np.diff(first)
                sizes.append(n)
                sets += [d.tobytes() if some else None for d, some in zip(_digests(hashes, first), n, strict=True)]
                signs.append(parities(hashes, first))
                own = iter(half_keys(hashes, first))
                keys += [next(own).tobytes() if some else None for some in n]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("name"),
                    pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                    pa.array(sets, pa.binary()), pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(
                        np.arange(0, batch.num_rows * width + 1, width, dtype=np.int32),
                        np.concatenate(signs).ravel().view(np.int64) if signs else np.zeros(0, np.int64),
                    ),
                ],
                names=["key", "name", "n", "cls", "halves", "parity"],
            )

    return lx.tidy(sign)


def _list_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and half key; the number of its group in the low bits."""
    for batch in batches:
        raw = b"".join(batch.column("halves").to_pylist())
        keys = np.frombuffer(raw, np.uint64).reshape(-1, 2 * GROUPS)
        group = np.arange(2 * GROUPS, dtype=np.uint64)
        keys = ((keys & ~np.uint64(31)) | group).astype(np.int64)
        ids = np.repeat(batch.column("id").to_numpy(), 2 * GROUPS)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.ravel())], names=["id", "half"])


def _set_lister(size: int):
    def list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = lx.text_bytes(batch.column("text"))
            sets, own = [], []
            for a, b in lx.pieces(offsets):
                hashes, first = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                raw = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :SET_BYTES]).tobytes()
                sets += [raw[SET_BYTES * x : SET_BYTES * y] for x, y in zip(first[:-1], first[1:], strict=True)]
                own += [d.tobytes() for d in _digests(hashes, first)]
            # Where a key repeats, only the text that made the class is its set.
            listed = pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sets, pa.binary())], names=["id", "shingles"]
            )
            yield listed.filter(pc.equal(batch.column("cls"), pa.array(own, pa.binary())))

    return list_sets


def _unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // SET_BYTES, 8), np.uint8)
    wide[:, :SET_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, SET_BYTES)
    return wide.view(np.uint64).ravel()


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                x, y = np.unique(_unpacked(a)), np.unique(_unpacked(b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

    return confirm


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``links`` (a, b): the smallest node that can be reached.

    Each round takes the smallest label of all neighbours and then that label's own label,
    until nothing changes; the state between rounds is a written table.
    """
    edges = stored(links.select("a", "b").unionAll(links.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = edges.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        closer = stored(labels.join(near, "node").select("node", F.least("label", "near").alias("next"), "label"), "closer")
        jump = closer.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = stored(
            closer.join(jump, "next").select("node", F.least("next", "far").alias("next"), "label"), "moved"
        )
        changed = moved.filter(F.col("next") != F.col("label")).limit(1).count()
        forget(labels, closer)
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    of_b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    of_a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    both = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(_confirmer(percent), "a long, b long, linked boolean")


def _tables(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, place, id, pivot, rank) of all buckets with two classes or more, ``place``
    the number of the table; and (id, halves) with each class's shared half keys."""
    listed = stored(classes.select("id", "halves").mapInArrow(_list_halves, "id long, half long"), "halves")
    shared = listed.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    cells = F.map_from_entries(F.collect_list(F.struct(F.col("half").bitwiseAND(F.lit(31)).cast("int"), F.col("half"))))
    own = listed.join(shared, "half").groupBy("id").agg(cells.alias("cells"), F.sum("n").alias("rank"))
    # One place per group; null where no other class shares the half key.
    groups = F.sequence(F.lit(0), F.lit(2 * GROUPS - 1))
    own = stored(own.select("id", "rank", F.transform(groups, lambda g: F.try_element_at("cells", g)).alias("halves")), "own")
    tables = F.sequence(F.lit(0), F.lit(GROUPS * GROUPS - 1))
    keys = F.transform(
        tables,
        lambda t: F.struct(
            t.alias("place"),
            F.get("halves", (t / GROUPS).cast("int")).alias("first"),
            F.get("halves", t % GROUPS + GROUPS).alias("second"),
        ),
    )
    keys = F.filter(keys, lambda k: k["first"].isNotNull() & k["second"].isNotNull())
    rows = own.select("id", "rank", F.inline(keys)).select(
        F.xxhash64("first", "second").alias("bucket"), "place", "id", "rank"
    )
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("rank", "id")).alias("top"))
    full = full.filter("n > 1").select("bucket", F.col("top.id").alias("pivot"), F.col("top.rank").alias("rank"))
    buckets = stored(rows.drop("rank").join(full, "bucket"), "buckets")
    forget(listed)
    return buckets, own.select("id", "halves")


def _labelled(ids: DataFrame, links: DataFrame) -> DataFrame:
    """``ids`` with the ``label`` of their component."""
    labels = components(links).withColumnRenamed("node", "id")
    return ids.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _links(buckets: DataFrame, halves: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) that give the same components as all links between classes."""

    def similar_sizes(x: Column, y: Column) -> Column:
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    best = buckets.groupBy(F.col("id").alias("a")).agg(F.max(F.struct("rank", "pivot")).alias("top"))
    pairs = best.select("a", F.col("top.pivot").alias("b")).filter("a <> b")
    to_pivot = stored(_confirmed(pairs, sets, percent), "checked")
    first = to_pivot.filter("linked").select("a", "b")
    labels = stored(_labelled(sizes, first), "labels")
    rows = buckets.select("bucket", "place", "id").join(labels.select("id", "label"), "id")
    parts = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("bucket").agg(
        F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels")
    )
    unfinished = main.filter("labels > 1").select("bucket", F.col("most.label").alias("main"))
    open_rows = rows.join(unfinished, "bucket").join(labels.drop("label"), "id").join(halves, "id")
    open_rows = stored(open_rows.withColumn("minor", F.col("label") != F.col("main")).drop("main"), "open")
    x, y = open_rows.alias("x"), open_rows.filter("minor").alias("y")
    differ = sum(
        F.bit_count(F.get("x.parity", F.lit(i)).bitwiseXOR(F.get("y.parity", F.lit(i)))) for i in range(PARITY_BITS // 64)
    )
    agree = F.zip_with("x.halves", "y.halves", lambda a, b: F.coalesce(a == b, F.lit(False)))
    # The pair is taken in the first of the tables that it shares.
    here = (F.array_position(F.slice(agree, 1, GROUPS), True) - 1) * GROUPS + (
        F.array_position(F.slice(agree, GROUPS + 1, GROUPS), True) - 1
    )
    met = x.join(
        y,
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.label") != F.col("y.label"))
        & (~F.col("x.minor") | (F.col("x.id") < F.col("y.id")))
        & similar_sizes(F.col("x.n"), F.col("y.n"))
        & ((100 + percent) * differ <= (100 - percent) * (F.col("x.n") + F.col("y.n")))
        & (here == F.col("x.place")),
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    second = stored(_confirmed(met, sets, percent), "checked")
    return first.unionAll(second.filter("linked").select("a", "b"))


def _grouped(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """(key, name, n, label, component_id) of all rows; ``name`` is a hash of the text."""
    kind = docs.schema[key].dataType.simpleString()
    name = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("name")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), name)
    fields = f"key {kind}, name long, n long, cls binary, halves binary, parity array<long>"
    signed = stored(rows.mapInArrow(_signer(shingle), fields), "signed")
    filled = signed.filter(F.col("n") > 0)
    classes = filled.groupBy("cls").agg(
        F.min("key").alias("key"), *(F.max(c).alias(c) for c in ("n", "halves", "parity"))
    )
    # Numbered once and written, so that a number stays with its class.
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    buckets, halves = _tables(classes)
    met = buckets.select("id").distinct()
    # The texts of one document per class, for the classes that meet another one.
    chosen = classes.join(met, "id").select("id", "cls", F.col("key").alias("_key"))
    sets = stored(_sets_of(rows.select("key", "text"), signed, chosen, shingle), "sets")
    links = _links(buckets, halves, sets, classes.select("id", "n", "parity"), percent)
    of_class = _labelled(classes.select("id", "cls", "key"), links)
    smallest = of_class.groupBy("label").agg(F.min("key").alias("component_id"))
    named = stored(of_class.join(smallest, "label").select("cls", "label", "component_id"), "components")
    forget(buckets, sets)
    linked = filled.join(named, "cls").select("key", "name", "n", "label", "component_id")
    alone = signed.filter(F.col("n") == 0)
    return linked.unionAll(alone.select("key", "name", "n", F.lit(None).cast("long"), F.col("key")))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id`` and ``kept`` (the
    document whose key names its component)."""
    return _grouped(docs, key, text, shingle, percent).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest key.

    Rows that share key and text are one. Where the rows of a smallest key differ in their
    texts and are linked, the one whose text has the smallest hash stays.
    """
    grouped = _grouped(docs, key, text, shingle, percent).filter(F.col("key").eqNullSafe(F.col("component_id")))
    # Texts without words are linked with nothing, so each of them is a component.
    kept = grouped.groupBy("key", "label", F.when(F.col("n") == 0, F.col("name")).alias("empty")).agg(
        F.min("name").alias("_name")
    )
    names = row_names(F.col("key"), F.lit(""))
    kept = kept.select(names["_key"].alias("_key"), names["_none"].alias("_none"), "_name")
    return decided(docs, kept, key, text).select("row.*")


def _sets_of(rows: DataFrame, signed: DataFrame, chosen: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles) of the chosen classes, from a text of each."""
    texts = rows.join(chosen, F.col("key").eqNullSafe(F.col("_key"))).select("id", "cls", "text")
    listed = texts.mapInArrow(_set_lister(shingle), "id long, shingles binary")
    if signed.count() > signed.select("key").distinct().count():
        # Rows that repeat a key bring a set more than once.
        return listed.groupBy("id").agg(F.max("shingles").alias("shingles"))
    return listed
