"""Parquet tables: write, refresh and read back."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lagscope.session import scratch_dir

# Table properties: the folder a refreshed table reads, and the one it read before.
MADE_HERE = "lagscope.folder"
BEFORE = "lagscope.folder.before"


def read_raw(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A raw table. Time stamps stored as nanoseconds come as whole numbers in a session made
    by ``build_session``; Spark's own sessions reject such files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def land(df: DataFrame, path: str, series: Sequence[str] = (), cluster: Sequence[str] = ()) -> None:
    """Write snappy Parquet in place of what is there.

    ``series`` makes one folder per value, for up to some hundred series. The rebalance
    hint brings a series together in files of even size, and splits one with many rows
    over several tasks. ``cluster`` is for more series than that: rows are sorted by it
    across files, so a filter on it skips most of them, and a large series fills several.
    """
    if series:
        df = df.hint("rebalance", *series)
    elif cluster:
        df = df.repartitionByRange(*cluster).sortWithinPartitions(*cluster)
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*series).parquet(path)


def land_series(frames: Mapping[str, DataFrame], path: str) -> None:
    """Land several series of one shape in one job, each in its own folder."""
    named = [df.withColumn("series_id", F.lit(name)) for name, df in frames.items()]
    land(reduce(DataFrame.unionByName, named), path, ["series_id"])


def read_series(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """One of the landed series; only its folder is read."""
    landed = read_raw(spark, path, f"{schema}, series_id string")
    return landed.filter(F.col("series_id") == name).drop("series_id")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it from there.

    For results that several queries read: they survive the loss of an executor, which
    cached blocks do not, and what was read to make them is read once.
    """
    path = scratch_dir(df.sparkSession, purpose)
    land(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_observed(df: DataFrame, path: str, **metrics: Column) -> dict:
    """Write as ``land`` does and return aggregates over the rows written, taken on the way.

    They are taken next to the writer, where a task that runs twice counts once; above a
    shuffle, one whose output was lost would count again.
    """
    observation = Observation()
    land(df.observe(observation, *(column.alias(name) for name, column in metrics.items())), path)
    return observation.get


def materialize_observed(df: DataFrame, purpose: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """As ``materialize``, with aggregates over the rows written."""
    path = scratch_dir(df.sparkSession, purpose)
    found = land_observed(df, path, **metrics)
    return df.sparkSession.read.schema(df.schema).parquet(path), found


def refresh_table(df: DataFrame, table: str, root: str, order: Sequence[str] = ()) -> None:
    """Replace the whole content of a catalog table, its files sorted by ``order``.

    The new rows go to a folder of their own and the table is pointed at it once they
    are complete, so readers see the old rows or the new ones and never a part. Only
    where the columns changed is the table dropped and made anew; its files are never the
    catalog's to delete. A table that was not made here is refused. Of the earlier folders
    the last one stays, for readers still at work in it.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    land(df, path, cluster=order)
    written = spark.read.parquet(path)
    if spark.catalog.tableExists(table):
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        if MADE_HERE not in properties:
            raise ValueError(f"table {table} exists and was not made by a refresh")
        before, current = properties.get(BEFORE), properties.get(MADE_HERE)
        if spark.table(table).schema == written.schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{MADE_HERE}' = '{path}', '{BEFORE}' = '{current}')")
            spark.catalog.refreshTable(table)
            if before:
                remove(spark, before)
            return
        spark.sql(f"DROP TABLE {table}")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema.fields)
    spark.sql(
        f"CREATE TABLE {table} ({fields}) USING parquet LOCATION '{path}' TBLPROPERTIES ('{MADE_HERE}' = '{path}')"
    )


def store_buckets(df: DataFrame, table: str, root: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a catalog table dealt into ``buckets`` by ``keys``, one file each, sorted. Tables
    that are dealt alike are joined on these keys where they lie: nothing is shuffled again,
    however often they are joined. A table of that name is replaced."""
    path = f"{root.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    dealt.format("parquet").option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
