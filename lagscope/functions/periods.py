"""Calendar periods and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns that identify a period, per grain, in output order.
PERIOD_COLUMNS = {
    "month": ["month"],
    "quarter": ["year", "quarter", "year_quarter"],
    "year": ["year"],
}


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def period_parts(date: Column, grain: str) -> dict[str, Column]:
    """Fixed-width columns to group by; labels are made after the aggregation."""
    year = F.year(date).cast("bigint")
    if grain == "month":
        return {"month_start": F.trunc(date, "MM")}
    if grain == "quarter":
        return {"year": year, "quarter": F.quarter(date).cast("bigint")}
    if grain == "year":
        return {"year": year}
    raise ValueError(f"unknown grain {grain!r}: use month, quarter or year")


def period_labels(grain: str) -> dict[str, Column]:
    """Label columns computed from the columns of ``period_parts``."""
    if grain == "month":
        return {"month": month_label(F.col("month_start"))}
    if grain == "quarter":
        return {"year_quarter": quarter_label(F.col("year"), F.col("quarter"))}
    return {}
