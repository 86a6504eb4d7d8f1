"""Reading the tables, scratch tables, and the fold that learned models leave out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.session import scratch_dir

FOLDS = 4
HELD_OUT_FOLD = 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: Column) -> Column:
    """True for the fold that no model learns from; a null key belongs to no fold."""
    fold = F.crc32(key.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder all executors share and read it back: what follows does not
    depend on the executors that made it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the scratch tables behind these frames; nothing may read them any more."""
    for df in frames:
        spark = df.sparkSession
        paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def row_names(key: Column, text: Column) -> dict[str, Column]:
    """Columns that name a row by its key and text, nulls included; equal rows share them."""
    return {
        "_key": F.coalesce(key.cast("string"), F.lit("")),
        "_none": key.isNull(),
        "_name": F.xxhash64(F.coalesce(text, F.lit(""))),
    }


def decided(docs: DataFrame, decisions: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` names, one of each that share key and text:
    ``row`` holds the columns of ``docs``, whatever their names, next to those of
    ``decisions``."""
    names = row_names(F.col(key), F.col(text))
    packed = docs.select(F.struct("*").alias("row"), *(column.alias(name) for name, column in names.items()))
    return packed.join(decisions, list(names)).dropDuplicates(list(names))
