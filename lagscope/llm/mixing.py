"""Mix sources to target weights by entropy balancing.

Each document gets a rate: how often it is taken. Among all rates whose tokens add up to
the target of each source, entropy balancing takes those closest to 1 in relative
entropy, and these are exponentially tilted: rate = exp(lambda * size / mean size), held
at ``MOST_COPIES``. The multiplier of each source solves a convex dual of one unknown;
Newton's method finds it for all sources together, one Spark aggregation per step, over
the counts of documents per source and size (all that the dual depends on).

Rates become whole copies so that each source's tokens stay near its target: from the
largest size down, the documents of one size share the whole number of copies nearest to
their target plus what the sizes before have left over. The recursion runs over the
different sizes of a source, of which there are at most as many as the longest document
has words, and not over its rows. Which documents of a size get one copy more is decided
by a hash of their key, within ``SALTS`` parts of the group, so that a hot one is split.

Null texts have size 0, a null source is a source of its own, the last. Documents of size
0 take nothing. Rows that repeat count each. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagscope.llm.tables import decided, forget, row_names, stored

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SALTS = 256
#: From this step on every second one halves the bracket, so that any source ends.
PATIENCE = 30
#: Newton stops when every source is this close to its target, as a share of it.
CLOSE = 1e-9
WORD = r"[^\x20\x09-\x0D]+"
#: Sizes that one inner array of the rounding holds.
BLOCK = 256


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: ``sid``, ``source``, ``source_size``, ``mean_size``, ``target``.

    Sources in code point order, null last, weigh ``WEIGHTS`` in turn and share the sum of
    all sizes; a target stops at ``MOST_COPIES`` times its source's size and the excess is
    shared by weight among the rest until none is above. That is one level for all:
    target = least(cap, level * weight), found from the sources sorted by cap / weight.
    One row per source goes through one task.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sid = F.row_number().over(by_name) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in WEIGHTS)), F.col("sid") % len(WEIGHTS))
    cap = (MOST_COPIES * F.col("source_size")).cast("double")
    named = sums.withColumn("sid", sid).withColumns({"weight": weight, "cap": cap})
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levels = named.withColumn("level", rest / F.sum("weight").over(after))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.max(fits).over(whole)
    target = F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap"))
    mean = F.greatest(F.col("source_size") / F.col("docs"), F.lit(1.0))
    return levels.select("sid", "source", "source_size", mean.alias("mean_size"), "cap", target.alias("target"))


def _rate(tilt: Column) -> Column:
    # Held before exp, which would overflow on one very long document.
    return F.least(F.exp(F.least(tilt, F.lit(50.0))), F.lit(float(MOST_COPIES)))


def solve_tilts(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sid`` and its multiplier ``tilt``: safeguarded Newton steps on the dual.

    ``sizes`` has (sid, size, n). Each step is one aggregation over it; the state between
    steps is a written table of one row per source. A source is done when it is as ``CLOSE``
    as asked, or when no number is left between the ends of its bracket; steps go on until
    all are.
    """

    def exact(value: Column) -> Column:
        # Decimals add up to the same in any order, so reruns find the same multipliers.
        return F.sum(value.cast("decimal(38,6)")).cast("double")

    open_ends = {"low": F.lit(float("-inf")), "high": F.lit(float("inf")), "tilt": F.lit(0.0)}
    # Those at their cap, or without any target, need no tilt.
    free = (F.col("target") > 0) & (F.col("target") < F.col("cap") * (1 - 1e-12))
    state = stored(sources.filter(free).select("sid", "mean_size", "target").withColumns(open_ends), "tilts")
    for step in count():
        x = F.col("size") / F.col("mean_size")
        rate = _rate(F.col("tilt") * x)
        tokens = F.col("n") * F.col("size")
        bends = F.when(rate < MOST_COPIES, tokens * x * rate).otherwise(0.0)
        moved = (
            sizes.join(state, "sid")
            .groupBy("sid")
            .agg(
                *(F.first(c).alias(c) for c in ("mean_size", "target", "low", "high", "tilt")),
                (exact(tokens * rate) - F.first("target")).alias("off"),
                exact(bends).alias("bend"),
            )
            .withColumns({
                "low": F.when(F.col("off") < 0, F.col("tilt")).otherwise(F.col("low")),
                "high": F.when(F.col("off") > 0, F.col("tilt")).otherwise(F.col("high")),
            })
        )
        newton = F.col("tilt") - F.try_divide(F.col("off"), F.col("bend"))
        halfway = (
            F.when(F.col("low") == float("-inf"), 2 * F.col("high") - 1)
            .when(F.col("high") == float("inf"), 2 * F.col("low") + 1)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        if step >= PATIENCE and step % 2:
            inside = F.lit(False)
        bounded = (F.col("low") > float("-inf")) & (F.col("high") < float("inf"))
        nothing_between = bounded & ((halfway <= F.col("low")) | (halfway >= F.col("high")))
        done = (F.abs("off") <= CLOSE * F.col("target")) | nothing_between
        after = stored(
            moved.select(
                "sid", "mean_size", "target", "low", "high",
                F.when(done, F.col("tilt")).when(inside, newton).otherwise(halfway).alias("tilt"),
                done.alias("done"),
            ),
            "tilts",
        )
        forget(state)
        all_done = after.filter(~F.col("done")).isEmpty()
        state = after.drop("done")
        if all_done:
            break
    return state.select("sid", "tilt")


def whole_copies(rated: DataFrame) -> DataFrame:
    """(sid, size, n, rate) to the same with ``copies``, without size 0: whole copies shared by
    the n documents of one size, so that each source's tokens come as near to the sum of rates
    as its smallest documents allow."""
    row = F.struct(F.col("size"), F.col("n"), F.col("rate"))
    per_source = rated.filter(F.col("size") > 0).groupBy("sid").agg(F.sort_array(F.collect_list(row), asc=False).alias("rows"))
    kind = "array<struct<size:bigint,n:bigint,rate:double,copies:bigint>>"

    def share(state: Column, r: Column) -> Column:
        due = r["n"] * r["rate"] * r["size"] + state["left"]
        copies = F.least(F.greatest(F.round(due / r["size"]), F.lit(0.0)), (MOST_COPIES * r["n"]).cast("double"))
        given = F.struct(*(r[c].alias(c) for c in ("size", "n", "rate")), copies.cast("long").alias("copies"))
        return F.struct((due - copies * r["size"]).alias("left"), F.array_append(state["done"], given).alias("done"))

    def block(state: Column, first: Column) -> Column:
        inner = F.aggregate(
            F.slice("rows", first, BLOCK),
            F.struct(state["left"].alias("left"), F.array().cast(kind).alias("done")),
            share,
        )
        # One array of arrays, so that long lists of sizes are not copied at every step.
        return F.struct(inner["left"].alias("left"), F.array_append(state["blocks"], inner["done"]).alias("blocks"))

    firsts = F.sequence(F.lit(1), F.size("rows"), F.lit(BLOCK))
    zero = F.struct(F.lit(0.0).alias("left"), F.array().cast(f"array<{kind}>").alias("blocks"))
    shared = F.aggregate(firsts, zero, block, lambda state: F.flatten(state["blocks"]))
    return per_source.select("sid", F.inline(shared))


def _mixed(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    sized = stored(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
            row_names(F.col(key), F.col(text))["_name"].alias("name"),
        ),
        "sizes",
    )
    sources = stored(source_targets(sized), "sources")
    rows = sized.withColumn("salt", salt).join(sources, sized["source"].eqNullSafe(sources["source"])).drop("source")
    parts = stored(rows.groupBy("sid", "size", "salt").agg(F.count(F.lit(1)).alias("n")), "parts")
    # Stored, since every Newton step reads it: what a step plans and runs is as small as can be.
    sizes = stored(parts.groupBy("sid", "size").agg(F.sum("n").alias("n")), "counts")
    tilts = solve_tilts(sizes, sources)
    tilted = _rate(F.col("tilt") * F.col("size") / F.col("mean_size"))
    at_end = F.when(F.col("target") > 0, float(MOST_COPIES)).otherwise(0.0)
    rated = sizes.join(sources, "sid").join(tilts, "sid", "left").withColumn("rate", F.coalesce(tilted, at_end))
    copies = whole_copies(rated.select("sid", "size", "n", "rate")).withColumnRenamed("n", "group")
    # The copies of a size, dealt to its parts in proportion to their documents.
    in_order = Window.partitionBy("sid", "size").orderBy("salt")
    seen = F.sum("n").over(in_order)
    each = F.floor(F.col("copies") / F.col("group"))
    over = F.col("copies") - each * F.col("group")
    upto = F.call_function("div", over * seen, F.col("group"))
    dealt = stored(
        parts.join(copies, ["sid", "size"])
        .withColumns({"each": each, "upto": upto})
        .withColumn("more", F.col("upto") - F.coalesce(F.lag("upto").over(in_order), F.lit(0)))
        .select("sid", "size", "salt", "each", "more", "rate"),
        "dealt",
    )
    forget(parts, sizes, tilts)
    rank = F.row_number().over(Window.partitionBy("sid", "size", "salt").orderBy(F.xxhash64("key", F.lit(1)), "key"))
    mixed = rows.join(dealt, ["sid", "size", "salt"], "left")
    own = F.coalesce(F.col("each") + F.when(rank <= F.col("more"), 1).otherwise(0), F.lit(0)).cast("long")
    return mixed.withColumn("copies", own)


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: key, ``size``, ``source_size``, ``target``, ``rate``,
    ``copies`` (0 to 3) and ``taken`` = copies * size."""
    return _mixed(docs, key, text, source).select(
        F.col("key").alias(key), "size", "source_size", "target", F.coalesce("rate", F.lit(1.0)).alias("rate"), "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def take_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, its columns unchanged.

    Rows that share key and text stand in for each other.
    """
    names = row_names(F.col("key"), F.lit(""))
    copies = (
        _mixed(docs, key, text, source)
        .groupBy(names["_key"].alias("_key"), names["_none"].alias("_none"), F.col("name").alias("_name"))
        .agg(F.sum("copies").alias("_copies"))
        .filter(F.col("_copies") > 0)
    )
    taken = decided(docs, copies, key, text)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
