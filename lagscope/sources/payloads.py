"""Landed JSON payloads to raw rows.

Each file holds one document and documents are read in parallel. The series a document
belongs to is its ``series_id=...`` folder, or else its file name. A document that is cut
short, or that holds an error in place of data, stops the job: a series must not go
missing without a word. An empty list of observations is data.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.sources.schemas import CHART_PAYLOAD, NANOS_PER_SECOND, OBSERVATION_PAYLOAD


def _read_documents(spark: SparkSession, path: str, schema: str, foldered: bool, one_per_line: bool) -> DataFrame:
    schema = f"{schema}, series_id string" if foldered else schema
    documents = spark.read.schema(schema).json(path, multiLine=not one_per_line, mode="FAILFAST")
    if foldered:
        return documents
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.json)?$", 1)
    return documents.withColumn("series_id", name)


def _required(value: Column, what: str) -> Column:
    message = F.concat(F.lit(f"document without {what}: "), F.coalesce("series_id", F.lit("?")))
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)


def _parallel(stamps: Column, arrays: dict[str, Column]) -> Column:
    """``stamps``, where every array is as long: a shorter one would be filled up with NULL, and
    its values might belong to other days."""
    same = reduce(and_, (F.coalesce(F.size(array) == F.size(stamps), F.lit(False)) for array in arrays.values()))
    sizes = (F.concat(F.lit(f", {name} "), F.coalesce(F.size(array).cast("string"), F.lit("none"))) for name, array in arrays.items())
    lengths = F.concat(F.lit("timestamp "), F.size(stamps).cast("string"), *sizes)
    message = F.concat(F.lit("arrays of unequal length in "), F.coalesce("series_id", F.lit("?")), F.lit(": "), lengths)
    return F.when(same, stamps).otherwise(F.raise_error(message))


def flatten_chart(documents: DataFrame) -> DataFrame:
    """Parallel arrays to one row per time stamp, in the shape of the raw price table. Arrays of
    unequal length stop the job."""
    result = F.get("chart.result", F.lit(0))
    quote = F.get(result["indicators"]["quote"], F.lit(0))
    adjusted = F.get(result["indicators"]["adjclose"], F.lit(0))["adjclose"]
    stamps = _required(F.when(quote.isNotNull() & adjusted.isNotNull(), result["timestamp"]), "result, quote or adjclose")
    arrays = {name: quote[name] for name in ("open", "high", "low", "close")}
    arrays |= {"adj_close": adjusted, "volume": quote["volume"]}
    bars: Column = F.arrays_zip(
        _parallel(stamps, arrays).alias("timestamp"), *(array.alias(name) for name, array in arrays.items())
    )
    return documents.select("series_id", F.inline(bars)).select(
        "series_id",
        (F.col("timestamp") * NANOS_PER_SECOND).alias("date"),
        "open",
        "high",
        "low",
        "close",
        "adj_close",
        "volume",
    )


def flatten_observations(documents: DataFrame) -> DataFrame:
    """An array of records to one row each; every field stays text."""
    return documents.select("series_id", F.inline(_required(F.col("observations"), "observations")))


def read_chart_payloads(
    spark: SparkSession, path: str, foldered: bool = True, one_per_line: bool = False
) -> DataFrame:
    return flatten_chart(_read_documents(spark, path, CHART_PAYLOAD, foldered, one_per_line))


def read_observation_payloads(
    spark: SparkSession, path: str, foldered: bool = True, one_per_line: bool = False
) -> DataFrame:
    return flatten_observations(_read_documents(spark, path, OBSERVATION_PAYLOAD, foldered, one_per_line))
