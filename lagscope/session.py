"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import SparkSession

SETTINGS = {
    # Days must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    # Partition counts and join strategies follow the measured shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Do not look up the Python call site of every column expression: it takes longer
    # than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Time stamps stored as nanoseconds, which Spark otherwise rejects, are whole numbers.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings this package expects.

    On a cluster leave ``master`` to spark-submit and give ``shuffle_partitions``
    as an upper bound: adaptive execution merges the small ones.
    """
    builder = SparkSession.builder.appName("lagscope").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(named: str | None, warehouse: str) -> str:
    """The folder the cluster names for checkpoints, or else one in the warehouse, which the
    driver and all executors share as well."""
    return named.rstrip("/") if named else f"{warehouse.rstrip('/')}/_scratch"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path in a folder that all executors share, see ``shared_folder``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not named and warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        warnings.warn(
            f"spark.checkpoint.dir is not set and the warehouse {warehouse} may be a folder of the driver alone", stacklevel=2
        )
    folder = shared_folder(named, warehouse)
    return f"{folder}/{purpose}-{uuid.uuid4().hex}"
