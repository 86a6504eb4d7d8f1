"""Checks as frames of (model, column, check, failures)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagscope.operators.states import PeriodStates

RESULT = "(`model`, `column`, `check`, `failures`)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _results(counts: DataFrame, model: str, check: str, names: Sequence[str]) -> DataFrame:
    """One row of counts, its columns in the order of ``names``, to one row per name."""
    rows = ", ".join(
        f"{_text(model)}, {_text(name)}, {_text(check)}, CAST(`{column}` AS BIGINT)"
        for name, column in zip(names, counts.columns, strict=True)
    )
    return counts.selectExpr(f"stack({len(names)}, {rows}) AS {RESULT}")


def not_null_failures(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Rows without a value, for all columns in one pass."""
    counts = df.agg(*(F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in columns))
    return _results(counts, model, "not_null", columns)


def unique_failures(
    df: DataFrame, model: str, columns: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Values that occur more than once, or more than once per ``keys``, for all columns
    in one pass; NULL is no value.

    Values are counted before the shuffle, so one that fills a third of the rows is sent
    as one row per task.
    """
    values = ", ".join(f"{_text(c)}, CAST(`{c}` AS STRING)" for c in columns)
    counts = (
        df.select(*keys, F.expr(f"stack({len(columns)}, {values}) AS (`column`, `text`)"))
        .filter("`text` IS NOT NULL")
        .groupBy(*keys, "column", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(*(F.expr(f"count_if(`column` = {_text(c)} AND n > 1) AS `{c}`") for c in columns))
    )
    return _results(counts, model, "unique", columns)


def grain_failures(df: DataFrame, model: str, grain: Sequence[str]) -> DataFrame:
    """Combinations of the declared grain that occur more than once."""
    counts = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).agg(F.expr("count_if(n > 1) AS n"))
    return _results(counts, model, "grain", [", ".join(grain)])


def row_count_failures(df: DataFrame, model: str, expected: int) -> DataFrame:
    """How far the number of rows is from the declared one."""
    return _results(df.agg(F.expr(f"abs(count(1) - {expected}) AS n")), model, "row_count", ["*"])


def failures_in_one_pass(
    df: DataFrame,
    model: str,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    grain: Sequence[str] = (),
    rows: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """All declared checks of a model from one reading of it.

    Every row is spread to what the checks count: its missing values, the values that must
    not repeat, its grain, and itself. These are counted together before the shuffle, so a
    task sends one row per different value whatever it reads.
    """
    own = [*keys, *grain]
    key_text = ", ".join(f"CAST(`{k}` AS STRING)" for k in keys)
    entries = [("not_null", c, f"IF(`{c}` IS NULL, '', NULL)") for c in not_null]
    entries += [
        ("unique", c, f"IF(`{c}` IS NULL, NULL, to_json(array({', '.join(filter(None, [key_text, f'CAST(`{c}` AS STRING)']))})))")
        for c in unique
    ]
    if grain:
        entries.append(("grain", ", ".join(own), f"to_json(array({', '.join(f'CAST(`{c}` AS STRING)' for c in own)}))"))
    if rows is not None:
        entries.append(("row_count", "*", "''"))
    cells = ", ".join(f"{i}, {text}" for i, (_, _, text) in enumerate(entries))
    counted = (
        df.selectExpr(f"stack({len(entries)}, {cells}) AS (entry, text)")
        .filter("text IS NOT NULL")
        .groupBy("entry", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def failures(i: int, check: str) -> str:
        if check == "not_null":
            return f"coalesce(sum(IF(entry = {i}, n, 0)), 0)"
        if check == "row_count":
            return f"abs(coalesce(sum(IF(entry = {i}, n, 0)), 0) - {rows})"
        return f"count_if(entry = {i} AND n > 1)"

    found = counted.agg(*(F.expr(f"{failures(i, check)} AS `c{i}`") for i, (check, _, _) in enumerate(entries)))
    listed = ", ".join(
        f"{_text(model)}, {_text(name)}, {_text(check)}, CAST(c{i} AS BIGINT)" for i, (check, name, _) in enumerate(entries)
    )
    return found.selectExpr(f"stack({len(entries)}, {listed}) AS {RESULT}")


def failures_from_states(
    states: PeriodStates, model: str, not_null: Sequence[str] = (), unique: Sequence[str] = ()
) -> list[DataFrame]:
    """The checks of a staged model from the states of its months: missing values are counted
    there, and a date can only repeat in a month that has more rows than days."""
    results = [_results(states.missing(not_null), model, "not_null", not_null)] if not_null else []
    if set(unique) - {"date"}:
        raise ValueError(f"{model}: only dates are counted per month, not {sorted(unique)}")
    if unique:
        failing = states.frame.sparkSession.range(1).select(F.lit(states.failing_dates()).alias("date"))
        results.append(_results(failing, model, "unique", ["date"]))
    return results


def load_report(df: DataFrame, table: str, rows: int | None = None) -> DataFrame:
    """What was loaded: one row per column with its type, and the number of rows: counted here,
    or as it was observed when they were written (``sources.land_observed``)."""
    n = "n" if rows is None else f"{rows}L"
    listed = ", ".join(
        f"{_text(table)}, {_text(field.name)}, {_text(field.dataType.simpleString())}, {n}" for field in df.schema.fields
    )
    report = f"stack({len(df.schema.fields)}, {listed}) AS (`table`, `column`, `type`, `row_count`)"
    if rows is not None:
        return df.sparkSession.range(1).selectExpr(report)
    return df.agg(F.count(F.lit(1)).alias("n")).selectExpr(report)
