"""Refreshes that rewrite only the months that changed, published at once.

The states of months (``operators.states``) are stored by month. When observations of some
months are revised, the states of those months are made anew from their rows and take the
place of the old ones; all resampled models and marts follow from the states, whose number the
calendar bounds. States and marts are one version (``sources.versions``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.functions.casting import NANOS_PER_DAY
from lagscope.operators import PeriodStates
from lagscope.plans.models import MODEL_LAYERS, RAW_PRICE_TABLES, TABLE_ORDER, build_marts, intermediate_model
from lagscope.plans.models import FACT_INPUTS, INTERMEDIATE, stacked_states, stage
from lagscope.sources.versions import Version, Versions, written

STATES = "period_states"
MONTH = "month"


def _first_days(months: Collection[str]) -> list[tuple[dt.date, dt.date]]:
    """(first day, first day after) of months given as YYYY-MM."""
    spans = []
    for text in sorted(months):
        first = dt.date.fromisoformat(f"{text}-01")
        spans.append((first, (first + dt.timedelta(days=31)).replace(day=1)))
    return spans


def rows_of_months(table: str, raw: DataFrame, months: Collection[str]) -> DataFrame:
    """The raw rows whose staged date lies in one of ``months``. For prices that is a range of
    the raw column, which files can be skipped by."""
    spans = _first_days(months)
    if table in RAW_PRICE_TABLES:
        epoch = dt.date(1970, 1, 1)
        column, ends = F.col("date"), [((a - epoch).days * NANOS_PER_DAY, (b - epoch).days * NANOS_PER_DAY) for a, b in spans]
    else:
        column, ends = F.to_date(F.when(F.col("date").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.col("date").try_cast("date"))), spans
    wanted = F.lit(False)
    for first, after in ends:
        wanted |= (column >= first) & (column < after)
    return raw.filter(wanted)


def _with_month(states: DataFrame) -> DataFrame:
    return states.withColumn(MONTH, F.coalesce(F.date_format("month_start", "yyyy-MM"), F.lit("none")))


def states_in(spark: SparkSession, version: Version, raw: Mapping[str, DataFrame], keys: Sequence[str] = ()) -> dict[str, PeriodStates]:
    """The states of a version by raw table; ``raw`` is only read where dates repeat."""
    stored = version.read(spark, STATES)
    most = {r["series_id"]: r["most"] for r in stored.groupBy("series_id").agg(F.max("rows").alias("most")).collect()}
    return {
        table: PeriodStates(
            stored.filter(F.col("series_id") == table).drop("series_id"), stage(table, df, keys), tuple(keys), most.get(table, 0) <= 1
        )
        for table, df in raw.items()
    }


def refresh(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, keys: Sequence[str] = (), months: Collection[str] | None = None,
) -> Version:
    """Publish a new version of the states and the marts: from all of ``raw``, or after a
    revision of ``months`` (YYYY-MM) from their rows and the states of the version before.

    ``sources.Conflict`` where another refresh was published meanwhile; nothing of this one is
    then seen, and it may be run again.
    """
    versions = Versions(spark, root)
    base, folder = versions.latest(), versions.new_folder()
    partly = months is not None and STATES in base.tables
    chosen = {t: rows_of_months(t, df, months) for t, df in raw.items()} if partly else raw
    fresh = written(_with_month(stacked_states(chosen, keys)), f"{folder}/{STATES}", versions, MONTH)
    if partly:
        kept = {m: path for m, path in base.folders(STATES).items() if m not in months}
        fresh = {**fresh, "folders": {**kept, **fresh["folders"]}}
    states = states_in(spark, Version(base.number, {STATES: fresh}), raw, keys)
    tables = {STATES: fresh}

    def store(df: DataFrame, name: str) -> DataFrame:
        tables[name] = written(df, f"{folder}/{name}", versions, order=[*keys, *TABLE_ORDER.get(name, ())])
        return Version(0, tables).read(spark, name)

    build_marts({name: intermediate_model(name, states, keys) for name in FACT_INPUTS}, store, keys)
    return versions.commit(base, tables)


def snapshot(spark: SparkSession, root: str, raw: Mapping[str, DataFrame], keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All resampled models and marts of the latest version, which belong together whatever is
    published while they are read."""
    version = Versions(spark, root).latest()
    states = states_in(spark, version, raw, keys)
    marts = {name: version.read(spark, name) for name in MODEL_LAYERS["mart"]}
    return {**{name: intermediate_model(name, states, keys) for name in INTERMEDIATE}, **marts}
