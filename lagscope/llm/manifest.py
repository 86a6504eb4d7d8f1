"""Merkle manifest of a table: a hash per row, a tree per group, and one root over all.

Every node carries the interval of leaf ranks that it covers, in its tree. Leaves are ranked
by a sort over all tasks, and a shuffle climbs ``BAND`` levels at once: it brings together
the nodes of one level whose ranks share a bucket, a bounded block of them. Going down, a
block is joined with the one node of the band above that has its bucket and whose interval
contains it, so both sides of each join hold a row per block and no key is hot. The siblings
of a node are what its parent's interval holds beside its own.

Rows of one key are ordered by their hash, and null keys come first; equal rows share a hash,
so their order does not matter. A null group is a group, the first one. A null field counts as
"-", so it differs from an empty one. An empty table has no tree and gives no rows; a group of
one row has that row's hash for its root, and so has a table of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagscope.llm.tables import stored

FAN_IN = 2
#: Levels climbed in one shuffle; a block holds FAN_IN ** BAND nodes at most.
BAND = 8
#: monotonically_increasing_id: the partition above this bit, the row within it below.
ROW_BITS = 33


def hashed(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def row_hash(fields: Sequence[Column]) -> Column:
    """Each field as its length in bytes, a colon and its text, so that no two rows read alike."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return hashed(*(framed(field) for field in fields))


def group_name(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first, others by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def with_ranks(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves``, which must be stored, with their ``rank`` in their ``tree`` from 0, and the
    number ``n`` of leaves that the tree has.

    A tree's leaves lie in consecutive sorted partitions; a partition's share of a tree starts
    where those before it end. Those shares are a row per tree and partition.
    """
    by = ["tree", *order, "_tie"]
    tied = leaves.withColumn("_tie", F.monotonically_increasing_id())
    in_order = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    placed = stored(in_order.withColumn("_place", F.monotonically_increasing_id()), "manifest-sorted")
    placed = placed.withColumn("_part", F.shiftright("_place", ROW_BITS))
    shares = placed.groupBy("tree", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "tree", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("n"),
    )
    ranked = placed.join(stored(shares, "manifest-shares"), ["tree", "_part"])
    return ranked.select(*leaves.columns, (F.col("_place") + F.col("_shift")).alias("rank"), "n")


# Expressions over a block are written as SQL: built call by call from Python, they took
# longer than the jobs.


def _is_root(node: str) -> str:
    """Only the root covers all leaves of its tree."""
    return f"{node}.hi - {node}.lo = n"


def _joined(nodes: str) -> str:
    return f"array_join(transform({nodes}, x -> x.hash), '')"


def _parents(nodes: str) -> str:
    """The level above: each run of FAN_IN nodes becomes one; a root stays as it is."""
    runs = f"transform(sequence(0, cast((size({nodes}) - 1) div {FAN_IN} AS int)), i -> slice({nodes}, i * {FAN_IN} + 1, {FAN_IN}))"
    parent = f"named_struct('lo', run[0].lo, 'hi', element_at(run, -1).hi, 'hash', sha2({_joined('run')}, 256))"
    return f"CASE WHEN {_is_root(f'{nodes}[0]')} THEN {nodes} ELSE transform({runs}, run -> {parent}) END"


def _with_levels(blocks: DataFrame) -> DataFrame:
    """The nodes of a block, ``nodes``, and of the levels above them up to its one ancestor."""
    bare = "transform(nodes, x -> named_struct('lo', x.lo, 'hi', x.hi, 'hash', x.hash))"
    blocks = blocks.withColumn("level0", F.expr(bare))
    for level in range(BAND):
        blocks = blocks.withColumn(f"level{level + 1}", F.expr(_parents(f"level{level}")))
    return blocks


def _steps(place: str) -> str:
    """From the node at ``place`` of a block up to the block's ancestor: what to hash before
    and after it at each level, found as the parent's interval without the node's own. Both
    are empty for a node that has no siblings."""
    steps = []
    for level in range(BAND):
        bucket = f"cast({place} div {FAN_IN ** (level + 1)} AS int)"
        own, parent = f"level{level}[cast({place} div {FAN_IN**level} AS int)]", f"level{level + 1}[{bucket}]"
        run = f"slice(level{level}, {bucket} * {FAN_IN} + 1, {FAN_IN})"
        left = f"filter({run}, x -> x.lo >= {parent}.lo AND x.hi <= {own}.lo)"
        right = f"filter({run}, x -> x.lo >= {own}.hi AND x.hi <= {parent}.hi)"
        step = f"named_struct('left', {_joined(left)}, 'right', {_joined(right)})"
        steps.append(f"CASE WHEN NOT ({_is_root(own)}) THEN {step} END")
    return f"array_compact(array({', '.join(steps)}))"


def _block_up(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Nodes of one level (tree, n, place, lo, hi, hash) as blocks of consecutive ones."""
    node = F.struct("lo", "hi", "hash", *carried)
    blocks = nodes.groupBy("tree", "n", _div(F.col("place"), FAN_IN**BAND).alias("bucket"))
    return blocks.agg(F.sort_array(F.collect_list(node)).alias("nodes"))


def _tops(blocks: DataFrame) -> DataFrame:
    """The one ancestor of each block, as a node of the next band."""
    # Picked, not exploded: Spark would push a filter on the array down through all levels.
    top = f"level{BAND}[0]"
    return _with_levels(blocks).selectExpr("tree", "n", "bucket AS place", f"{top}.lo AS lo", f"{top}.hi AS hi", f"{top}.hash AS hash")


def climb(ranked: DataFrame, carried: Sequence[str]) -> list[DataFrame]:
    """All bands of blocks, the leaves' first; the last has one block per tree."""
    most = ranked.agg(F.max("n")).first()[0] or 1
    leaves = ranked.withColumns({"place": F.col("rank"), "lo": F.col("rank"), "hi": F.col("rank") + 1})
    bands = [stored(_block_up(leaves, carried), "manifest-band")]
    width = FAN_IN**BAND
    while width < most:
        bands.append(stored(_block_up(_tops(bands[-1])), "manifest-band"))
        width *= FAN_IN**BAND
    return bands


def roots(bands: Sequence[DataFrame]) -> DataFrame:
    return _tops(bands[-1]).select("tree", "n", "hash")


def _children(carried: Sequence[str]) -> str:
    """The nodes of a block with their steps to the root, as rows for the band below."""
    own = "".join(f", '{c}', node.{c}" for c in carried)
    child = f"""named_struct('_tree', tree, '_bucket', bucket * {FAN_IN**BAND} + i, '_lo', node.lo, '_hi', node.hi,
        '_steps', concat({_steps("i")}, _steps){own})"""
    return f"inline(transform(nodes, (node, i) -> {child}))"


def descend(bands: Sequence[DataFrame], above: DataFrame, carried: Sequence[str], passed: Sequence[str]) -> DataFrame:
    """Per leaf the columns ``carried`` and the ``steps`` up to what ``above`` starts from:
    a row per tree with its size ``n``, its ``steps`` further up and the columns ``passed`` to
    all leaves."""
    whole = ["tree AS _tree", "0L AS _bucket", "0L AS _lo", "n AS _hi", "steps AS _steps"]
    above = above.selectExpr(*whole, *passed)
    for band in reversed(bands):
        own = carried if band is bands[0] else ()
        contained = "_lo <= nodes[0].lo AND element_at(nodes, -1).hi <= _hi"
        attached = band.join(above, F.expr(f"tree = _tree AND bucket = _bucket AND {contained}"))
        attached = _with_levels(attached.drop("_tree", "_bucket", "_lo", "_hi"))
        above = attached.selectExpr(_children(own), *passed)
    return above.withColumnRenamed("_steps", "steps").drop("_tree", "_bucket", "_lo", "_hi")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(steps, leaf, lambda own, step: hashed(step["left"], own, step["right"]))


def proof_hash(steps: Column) -> Column:
    """One hash over all siblings, from the lowest level up and from left to right."""
    return hashed(F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), ""))


def build_manifest(docs: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "lang", received: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, its hash ``leaf``, the ``subroot`` of its group, the
    ``root``, and ``steps``, the siblings that lead from the leaf to the root.

    ``received`` is the hash of the row as someone else holds it, null where it is the same;
    it comes back as ``received``, and ``fold`` of it tells whether it belongs to the root.
    """
    hashes = docs.select(
        F.col(key).alias("key"), group_name(F.col(group)).alias("tree"), row_hash([F.col(f) for f in fields]).alias("hash"),
        (F.lit(None).cast("string") if received is None else received).alias("received"),
    )
    carried = ["key", "received"]
    bands = climb(with_ranks(stored(hashes, "manifest-leaves"), ["key", "hash"]), [*carried])
    # The trees of the groups are the leaves of one more tree.
    subroots = stored(roots(bands).selectExpr("'' AS tree", "tree AS group", "n AS size", "hash"), "manifest-subroots")
    groups = climb(with_ranks(subroots, ["group"]), ["group", "size"])
    root = roots(groups).selectExpr("tree", "n", "cast(array() AS array<struct<left:string,right:string>>) AS steps", "hash AS root")
    top = descend(groups, root, ["group", "size", "hash"], ["root"])
    top = stored(top.selectExpr("group AS tree", "size AS n", "steps", "hash AS subroot", "root"), "manifest-top")
    found = descend(bands, top, [*carried, "hash"], ["subroot", "root"])
    return found.select(F.col("key").alias(key), F.col("hash").alias("leaf"), "subroot", "root", "received", "steps")
