"""The same queries in plain SQL over the same tables, for comparison."""

from __future__ import annotations

import re

# Fixed values, written out here a second time, so that a change in the library that is
# not meant turns a comparison red.
INDICATORS = {"new_orders_yoy": "New Orders YoY", "ppi_yoy": "PPI YoY", "inventory_yoy": "Inventory YoY"}
LAGS = {"lag_1_year": 4, "lag_2_year": 8, "lag_3_year": 12, "lag_4_year": 16, "lag_5_year": 20}
LAG_LABELS = {
    "lag_1_year": "Lag 1Y", "lag_2_year": "Lag 2Y", "lag_3_year": "Lag 3Y", "lag_4_year": "Lag 4Y",
    "lag_5_year": "Lag 5Y",
}
# Each model, the columns that must hold a value, and those whose values must not repeat.
_DECLARED_CHECKS = """
stg_smh_prices: date open high low close adjusted_close volume; date
stg_sp500_prices: date open high low close adjusted_close volume; date
stg_fred_inventories: realtime_start realtime_end date value; date
stg_fred_new_orders: realtime_start realtime_end date value; date
stg_fred_semiconductor_ppi: realtime_start realtime_end date value; date
int_smh_prices: date open high low close adjusted_close volume month; date month
int_sp500_prices: date open high low close adjusted_close volume month; date month
int_fred_inventories: date month inventory; date month
int_fred_new_orders: date month new_orders; date month
int_fred_semiconductor_ppi: date month semiconductor_ppi; date month
int_smh_yearly: year date adjusted_close; year date
int_sp500_yearly: year date adjusted_close; year date
int_fred_new_orders_yearly: year new_orders; year
int_fred_ppi_yearly: year semiconductor_ppi; year
int_fred_inventories_yearly: ; year
int_smh_q: date year quarter year_quarter smh_value; date year_quarter
int_sp500_q: date year quarter year_quarter sp500_value; date year_quarter
int_fred_inventories_q: date year quarter year_quarter quarterly_inventory; date year_quarter
int_fred_new_orders_q: year quarter year_quarter new_orders; year_quarter
int_fred_ppi_q: year quarter year_quarter semiconductor_ppi; year_quarter
fct_smh_q: date year quarter year_quarter smh_value smh_qoq smh_yoy; date year_quarter
fct_smh_q_correlation: indicator; indicator
fct_key_kpi: date year quarter year_quarter;
"""
GRAIN = {"fct_smh_q": "year_quarter", "fct_smh_q_correlation": "indicator", "fct_key_kpi": "year_quarter"}
ROW_COUNT = {"fct_key_kpi": 1}

_SPLIT = [line.replace(";", ":").split(":") for line in _DECLARED_CHECKS.strip().splitlines()]
MODELS = [model for model, _, _ in _SPLIT]
NOT_NULL = {model: columns.split() for model, columns, _ in _SPLIT}
UNIQUE = {model: columns.split() for model, _, columns in _SPLIT}

# Common table expressions, by name, in the order they may refer to each other.

def _target_days(key: str = "", name: str = "target_days") -> str:
    keyed = f"{key}, " if key else ""
    return f"""
{name} AS (
    SELECT {keyed}CAST(l_shipdate AS DATE) AS date,
           max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS open,
           max(l_extendedprice) AS high,
           min(l_extendedprice) AS low,
           max(l_extendedprice * (1 - l_discount)) AS close,
           max(l_extendedprice) AS adjusted_close,
           CAST(round(CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) / 2) AS BIGINT) AS volume
    FROM lineitem GROUP BY {keyed}CAST(l_shipdate AS DATE))"""


TARGET_DAYS = _target_days()

BENCHMARK_DAYS = """
benchmark_days AS (
    SELECT CAST(o_orderdate AS DATE) AS date,
           max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS open,
           max(o_totalprice) AS high,
           min(o_totalprice) AS low,
           max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS close,
           max(o_totalprice) AS adjusted_close,
           count(*) AS volume
    FROM orders GROUP BY 1)"""


def _months(name: str, table: str, date: str, value: str, where: str = "") -> str:
    return f"""
{name} AS (
    SELECT CAST(date_trunc('month', {date}) AS DATE) AS date,
           CAST(min({date}) AS DATE) AS realtime_start,
           CAST(max({date}) AS DATE) AS realtime_end,
           {value} AS value
    FROM {table} {where} GROUP BY 1)"""


ORDER_MONTHS = _months(
    "order_months", "orders", "o_orderdate", "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)"
)
INVENTORY_MONTHS = _months(
    "inventory_months", "lineitem", "l_shipdate", "CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE)"
)
PPI_MONTHS = _months(
    "ppi_months", "lineitem", "l_shipdate", "max(l_extendedprice / l_quantity)", "WHERE l_returnflag = 'R'"
)


def _change(x: str, n: int, order: str, name: str, keys: str = "") -> str:
    over = f"{'PARTITION BY ' + keys + ' ' if keys else ''}ORDER BY {order}"
    return f"({x} / nullif(lag({x}, {n}) OVER ({over}), 0) - 1) * 100 AS {name}"


def _quarters(name: str, source: str, rule: str, value: str, prefix: str, column: str = "value") -> str:
    """A quarterly series and its changes; the last rule also has the date."""
    parts = "year(date) AS year, quarter(date) AS quarter"
    if rule == "last":
        resampled = f"""SELECT date, {parts}, {column} AS {value} FROM {source}
            QUALIFY row_number() OVER (PARTITION BY year(date), quarter(date) ORDER BY date DESC) = 1"""
    else:
        total = f"sum(CAST({column} AS DECIMAL(38, 9)))"
        measure = f"CAST({total} AS DOUBLE)" if rule == "sum" else f"CAST({total} AS DOUBLE) / count({column})"
        resampled = f"SELECT {parts}, {measure} AS {value} FROM {source} GROUP BY 1, 2"
    return f"""
{name} AS (
    SELECT *, year || '-Q' || quarter AS year_quarter,
           {_change(value, 1, "year, quarter", prefix + "_qoq")},
           {_change(value, 4, "year, quarter", prefix + "_yoy")}
    FROM ({resampled}))"""


TARGET_Q = _quarters("target_q", "target_days", "last", "smh_value", "smh", "adjusted_close")
BENCHMARK_Q = _quarters("benchmark_q", "benchmark_days", "last", "sp500_value", "sp500", "adjusted_close")
ORDERS_Q = _quarters("orders_q", "order_months", "sum", "new_orders", "new_orders")
PPI_Q = _quarters("ppi_q", "ppi_months", "avg", "semiconductor_ppi", "ppi")
INVENTORY_Q = _quarters("inventory_q", "inventory_months", "last", "quarterly_inventory", "inventory")

SOURCES = [TARGET_DAYS, BENCHMARK_DAYS, ORDER_MONTHS, INVENTORY_MONTHS, PPI_MONTHS]
QUARTERS = [*SOURCES, TARGET_Q, BENCHMARK_Q, ORDERS_Q, PPI_Q, INVENTORY_Q]

_SHARED_SELECT = """
           sp500_value, sp500_qoq, sp500_yoy,
           smh_qoq - sp500_qoq AS smh_vs_sp500_qoq, smh_yoy - sp500_yoy AS smh_vs_sp500_yoy,
           new_orders, new_orders_qoq, new_orders_yoy,
           semiconductor_ppi, ppi_qoq, ppi_yoy,
           quarterly_inventory, inventory_qoq, inventory_yoy"""


def _fact(target: str, key: str = "") -> str:
    keyed = f"t.{key}, " if key else ""
    latest = f"max(year_quarter) OVER ({'PARTITION BY ' + key if key else ''})"
    return f"""
known AS (
    SELECT {keyed}t.date, t.year, t.quarter, t.year_quarter, smh_value, smh_qoq, smh_yoy, {_SHARED_SELECT}
    FROM {target} t
    LEFT JOIN benchmark_q USING (year_quarter) LEFT JOIN orders_q USING (year_quarter)
    LEFT JOIN ppi_q USING (year_quarter) LEFT JOIN inventory_q USING (year_quarter)
    WHERE smh_qoq IS NOT NULL AND smh_yoy IS NOT NULL),
fact AS (
    SELECT * EXCLUDE (latest_quarter)
    FROM (SELECT *, {latest} AS latest_quarter FROM known) WHERE year_quarter < latest_quarter)"""


FACT = [*QUARTERS, _fact("target_q")]

SUPPLIER_Q = f"""
supplier_last AS (
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, year(l_shipdate) AS year, quarter(l_shipdate) AS quarter,
           l_extendedprice AS smh_value
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)
                               ORDER BY CAST(l_shipdate AS DATE) DESC, l_extendedprice DESC) = 1),
supplier_q AS (
    SELECT *, year || '-Q' || quarter AS year_quarter,
           {_change("smh_value", 1, "year, quarter", "smh_qoq", "l_suppkey")},
           {_change("smh_value", 4, "year, quarter", "smh_yoy", "l_suppkey")}
    FROM supplier_last)"""
PANEL_FACT = [*QUARTERS, SUPPLIER_Q, _fact("supplier_q", "l_suppkey")]


EDGE_Q = """
edged AS (
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
           CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN -l_extendedprice WHEN 3 THEN l_extendedprice * 1e9
                WHEN 4 THEN floor(l_extendedprice) + l_extendedprice / 1e9 ELSE l_extendedprice END AS price
    FROM lineitem),
edge_q AS (
    SELECT l_suppkey, date, year(date) AS year, quarter(date) AS quarter, year || '-Q' || quarter AS year_quarter,
           price AS smh_value
    FROM edged
    QUALIFY row_number() OVER (PARTITION BY l_suppkey, year(date), quarter(date)
                               ORDER BY date DESC, price DESC NULLS LAST) = 1)"""


# Some of the target's and of an indicator's values are not known.
_GAPS = """
gaps AS (
    SELECT * REPLACE (CASE WHEN quarter <> 2 THEN smh_vs_sp500_yoy END AS smh_vs_sp500_yoy,
                      CASE WHEN quarter <> 3 THEN new_orders_yoy END AS new_orders_yoy)
    FROM fact)"""


def _bank(key: str = "", fact: str = "fact") -> str:
    keyed = f"{key}, " if key else ""
    stacked = " UNION ALL ".join(
        f"SELECT {keyed}year, quarter, smh_vs_sp500_yoy, '{label}' AS indicator, {column} AS value FROM {fact}"
        for column, label in INDICATORS.items()
    )
    lags = ", ".join(
        f"lag(value, {n}) OVER (PARTITION BY {keyed}indicator ORDER BY year, quarter) AS {name}"
        for name, n in LAGS.items()
    )
    return f"\nbank AS (SELECT *, {lags} FROM ({stacked}))"


def _matrix(key: str = "") -> str:
    keyed = f"{key}, " if key else ""

    def cell(lag: str) -> str:
        pairs = f"FILTER (WHERE smh_vs_sp500_yoy IS NOT NULL AND {lag} IS NOT NULL)"
        varies = " AND ".join(f"min({x}) {pairs} < max({x}) {pairs}" for x in ("smh_vs_sp500_yoy", lag))
        # Sums of doubles can come out a little beyond 1.
        return f"CASE WHEN {varies} THEN greatest(-1.0, least(1.0, corr(smh_vs_sp500_yoy, {lag}))) END AS {lag}"

    return f"\nmatrix AS (SELECT {keyed}indicator, {', '.join(cell(lag) for lag in LAGS)} FROM bank GROUP BY ALL)"


def _cells(key: str = "") -> str:
    keyed = f"{key}, " if key else ""
    rows = " UNION ALL ".join(
        f"SELECT {keyed}indicator, '{text}' AS lag_period, {lag} AS correlation FROM matrix"
        for lag, text in LAG_LABELS.items()
    )
    return f"\ncells AS ({rows})"


def _ranked(key: str = "") -> str:
    over = f"{'PARTITION BY ' + key if key else ''} ORDER BY round(abs(correlation), 12) DESC, indicator, lag_period"
    return f"""
ranked AS (
    SELECT *, row_number() OVER ({over}) AS rank FROM cells WHERE correlation IS NOT NULL)"""


def _kpi(key: str = "") -> str:
    keyed = f"{key}, " if key else ""

    def pick(rank: int, expression: str, name: str) -> str:
        same = f"AND r.{key} = latest.{key}" if key else ""
        return f"(SELECT {expression} FROM ranked r WHERE rank = {rank} {same}) AS {name}"

    label = "indicator || ' ' || lag_period"
    return f"""
latest AS (
    SELECT * FROM fact QUALIFY date = max(date) OVER ({'PARTITION BY ' + key if key else ''}))
SELECT {keyed}date, year, quarter, year_quarter, round(smh_yoy, 6) AS smh_return_yoy,
       round(smh_vs_sp500_yoy, 6) AS smh_vs_sp500_yoy,
       {pick(1, label, "top_reversal_driver")},
       {pick(1, "round(correlation, 6)", "top_reversal_driver_corr")},
       {pick(2, label, "top_margin_driver")},
       {pick(2, "round(correlation, 6)", "top_margin_driver_corr")}
FROM latest"""


def _with(parts: list[str], final: str) -> str:
    return f"WITH {','.join(parts)}\n{final}"


def _rounded(columns: dict[str, bool] | list[str], plain: list[str], source: str) -> str:
    listed = [*plain, *(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in columns)]
    return f"SELECT {', '.join(listed)} FROM {source}"


PRICES = ["open", "high", "low", "close", "adjusted_close"]
PERIOD = ["year", "quarter", "year_quarter"]
FACT_MEASURES = [
    "smh_value", "smh_qoq", "smh_yoy", "sp500_value", "sp500_qoq", "sp500_yoy", "smh_vs_sp500_qoq",
    "smh_vs_sp500_yoy", "new_orders", "new_orders_qoq", "new_orders_yoy", "semiconductor_ppi", "ppi_qoq",
    "ppi_yoy", "quarterly_inventory", "inventory_qoq", "inventory_yoy",
]
FACT_SELECT = _rounded(FACT_MEASURES, ["date", *PERIOD], "fact")
CELL_SELECT = "indicator, lag_period, round(correlation, 6) AS correlation"


def _exact(columns: list[str], plain: list[str], source: str) -> str:
    """Staged numbers with all their nine digits, as text."""
    return f"SELECT {', '.join([*plain, *(f'CAST(CAST({c} AS DECIMAL(38, 9)) AS VARCHAR) AS {c}' for c in columns)])} FROM {source}"


def _staged_months(months: str, name: str) -> str:
    # Sums stay exact here; as doubles they lose their last digits.
    months = months.replace("CAST(sum(CAST(", "(sum(CAST(").replace(" AS DECIMAL(18, 2))) AS DOUBLE)", " AS DECIMAL(18, 2))))")
    return _with([months], _exact(["value"], ["realtime_start", "realtime_end", "date"], name))


def _monthly_prices(days: str, name: str, key: str = "") -> str:
    keyed = f"{key}, " if key else ""
    month = f"""
month_ends AS (
    SELECT * FROM {name}
    QUALIFY row_number() OVER (PARTITION BY {keyed}date_trunc('month', date) ORDER BY date DESC) = 1),
changed AS (
    SELECT *, strftime(date, '%Y-%m') AS month,
           {_change("adjusted_close", 1, "date", "monthly_return", key)} FROM month_ends)"""
    plain = [*([key] if key else []), "date", "month", "volume"]
    return _with([days, month], _rounded([*PRICES, "monthly_return"], plain, "changed"))


def _monthly_changes(months: str, name: str, value: str, prefix: str) -> str:
    changed = f"""
changed AS (
    SELECT date, strftime(date, '%Y-%m') AS month, value AS {value},
           {_change("value", 12, "date", prefix + "_yoy")},
           {_change("value", 1, "date", prefix + "_mom")} FROM {name})"""
    return _with([months, changed], _rounded([value, f"{prefix}_yoy", f"{prefix}_mom"], ["date", "month"], "changed"))


def _quarterly(parts: list[str], name: str, value: str, prefix: str, dated: bool) -> str:
    plain = [*(["date"] if dated else []), *PERIOD]
    return _with(parts, _rounded([value, f"{prefix}_qoq", f"{prefix}_yoy"], plain, name))


def _yearly_last(days: str, name: str) -> str:
    changed = f"""
changed AS (
    SELECT year(date) AS year, date, adjusted_close, {_change("adjusted_close", 1, "date", "yearly_return")}
    FROM (SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY year(date) ORDER BY date DESC) = 1))"""
    return _with([days, changed], _rounded(["adjusted_close", "yearly_return"], ["year", "date"], "changed"))


def _yearly_combined(months: str, name: str, measure: str, value: str, change: str) -> str:
    changed = f"""
changed AS (
    SELECT *, {_change(value, 1, "year", change)}
    FROM (SELECT year(date) AS year, {measure} AS {value} FROM {name} GROUP BY 1))"""
    return _with([months, changed], _rounded([value, change], ["year"], "changed"))


_TOTAL = "CAST(sum(CAST(value AS DECIMAL(38, 9))) AS DOUBLE)"

_YEAR_END = f"""
changed AS (
    SELECT date, year(date) AS year, value AS yearly_inventory, {_change("value", 1, "date", "inventory_yoy")}
    FROM inventory_months WHERE month(date) = 12)"""

_ORDER_RECORDS = """
records AS (
    SELECT CAST(o_orderdate AS DATE) AS realtime_start,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS realtime_end,
           CAST(o_orderdate AS DATE) AS date,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END AS value,
           CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'settled' END AS series_id
    FROM orders)"""

# Stacked quarters of the three series in lineitem, each without its latest quarter.
_STACKED = " UNION ALL ".join(
    f"""SELECT '{name}' AS series_id, {date} AS date, year, quarter, year_quarter,
               round({value}, 6) AS value, round({prefix}_qoq, 6) AS qoq, round({prefix}_yoy, 6) AS yoy
        FROM {table} WHERE year_quarter < (SELECT max(year_quarter) FROM {table})"""
    for name, table, value, prefix, date in (
        ("smh", "target_q", "smh_value", "smh", "date"),
        ("inventory", "inventory_q", "quarterly_inventory", "inventory", "date"),
        (
            "semiconductor_ppi",
            "ppi_q",
            "semiconductor_ppi",
            "ppi",
            "(SELECT max(date) FROM ppi_months m WHERE year(m.date) = year AND quarter(m.date) = quarter)",
        ),
    )
)

def _pairs() -> str:
    """All pairs of a supplier and a nation, joined quarter by quarter at each lag."""
    lags = ", ".join(f"('{LAG_LABELS[name]}', {n})" for name, n in LAGS.items())
    varies = " AND ".join(f"min({c}) < max({c})" for c in ("y", "x"))
    cells = f"""
lags AS (SELECT * FROM (VALUES {lags}) AS t(lag_period, n)),
met AS (
    SELECT l_suppkey, c_nationkey, lag_period, smh_yoy AS y, new_orders_yoy AS x
    FROM lags, supplier_q s JOIN changed c ON s.year * 4 + s.quarter = c.year * 4 + c.quarter + n
    WHERE smh_yoy IS NOT NULL AND new_orders_yoy IS NOT NULL),
cells AS (
    SELECT * FROM (
        SELECT l_suppkey, c_nationkey, lag_period,
               CASE WHEN {varies} THEN greatest(-1.0, least(1.0, corr(y, x))) END AS correlation
        FROM met GROUP BY ALL)
    WHERE correlation IS NOT NULL)"""
    return _with([SUPPLIER_Q, _NATION_PANEL, cells], "")


_MONTH_PANEL = f"""
month_ends AS (
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, strftime(l_shipdate, '%Y-%m') AS month,
           l_extendedprice AS price
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate)
                               ORDER BY CAST(l_shipdate AS DATE) DESC, l_extendedprice DESC) = 1),
changed AS (SELECT *, {_change("price", 1, "date", "monthly_return", "l_suppkey")} FROM month_ends)"""

_NATION_PANEL = f"""
sums AS (
    SELECT c_nationkey, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS new_orders
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
changed AS (
    SELECT *, year || '-Q' || quarter AS year_quarter,
           {_change("new_orders", 1, "year, quarter", "new_orders_qoq", "c_nationkey")},
           {_change("new_orders", 4, "year, quarter", "new_orders_yoy", "c_nationkey")}
    FROM sums)"""

_LINE_ORDER = "date, l_orderkey, l_linenumber, l_partkey, l_suppkey, price"
_LINE_CHANGES = f"""
lines AS (
    SELECT l_returnflag, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           l_extendedprice AS price
    FROM lineitem),
changed AS (
    SELECT *, {_change("price", 1, _LINE_ORDER, "change_1", "l_returnflag")},
           {_change("price", 12, _LINE_ORDER, "change_12", "l_returnflag")}
    FROM lines)"""

_CHART_ROWS = """
SELECT l_returnflag AS series_id,
       CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) * 1000000000 AS date,
       round(max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END), 6) AS open,
       round(max(l_extendedprice), 6) AS high,
       round(min(l_extendedprice), 6) AS low,
       round(max(l_extendedprice * (1 - l_discount)), 6) AS close,
       round(max(l_extendedprice), 6) AS adj_close,
       round(CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) / 2, 6) AS volume
FROM lineitem GROUP BY l_returnflag, CAST(l_shipdate AS DATE)"""

# Raw price table: column names and types as landed.
_REPORT = " UNION ALL ".join(
    f"""SELECT 'smh_prices' AS "table", '{column}' AS "column", '{kind}' AS type,
               count(DISTINCT CAST(l_shipdate AS DATE)) AS row_count FROM lineitem"""
    for column, kind in [
        ("date", "bigint"),
        *((c, "double") for c in ("open", "high", "low", "close", "adj_close", "volume")),
    ]
)


# Models as common table expressions under their own names, for the checks.
def _all_models() -> list[str]:
    def months(model: str, source: str, value: str) -> str:
        return f"{model} AS (SELECT date, strftime(date, '%Y-%m') AS month, value AS {value} FROM {source})"

    def month_ends(model: str, source: str) -> str:
        return f"""{model} AS (SELECT *, strftime(date, '%Y-%m') AS month FROM {source}
            QUALIFY row_number() OVER (PARTITION BY date_trunc('month', date) ORDER BY date DESC) = 1)"""

    def year_ends(model: str, source: str) -> str:
        return f"""{model} AS (SELECT *, year(date) AS year FROM {source}
            QUALIFY row_number() OVER (PARTITION BY year(date) ORDER BY date DESC) = 1)"""

    def years(model: str, source: str, measure: str, value: str) -> str:
        return f"{model} AS (SELECT year(date) AS year, {measure} AS {value} FROM {source} GROUP BY 1)"

    def renamed(model: str, source: str) -> str:
        return f"{model} AS (SELECT * FROM {source})"

    return [
        renamed("stg_smh_prices", "target_days"),
        renamed("stg_sp500_prices", "benchmark_days"),
        renamed("stg_fred_inventories", "inventory_months"),
        renamed("stg_fred_new_orders", "order_months"),
        renamed("stg_fred_semiconductor_ppi", "ppi_months"),
        month_ends("int_smh_prices", "target_days"),
        month_ends("int_sp500_prices", "benchmark_days"),
        months("int_fred_inventories", "inventory_months", "inventory"),
        months("int_fred_new_orders", "order_months", "new_orders"),
        months("int_fred_semiconductor_ppi", "ppi_months", "semiconductor_ppi"),
        year_ends("int_smh_yearly", "target_days"),
        year_ends("int_sp500_yearly", "benchmark_days"),
        years("int_fred_new_orders_yearly", "order_months", "sum(value)", "new_orders"),
        years("int_fred_ppi_yearly", "ppi_months", "avg(value)", "semiconductor_ppi"),
        "int_fred_inventories_yearly AS (SELECT year(date) AS year FROM inventory_months WHERE month(date) = 12)",
        renamed("int_smh_q", "target_q"),
        renamed("int_sp500_q", "benchmark_q"),
        renamed("int_fred_inventories_q", "inventory_q"),
        renamed("int_fred_new_orders_q", "orders_q"),
        renamed("int_fred_ppi_q", "ppi_q"),
        renamed("fct_smh_q", "fact"),
        renamed("fct_smh_q_correlation", "matrix"),
        "fct_key_kpi AS (SELECT date, year, quarter, year_quarter FROM fact QUALIFY date = max(date) OVER ())",
    ]


def _check(model: str, column: str, check: str, failures: str) -> str:
    return f"""SELECT '{model}' AS model, '{column}' AS "column", '{check}' AS "check",
               CAST(({failures}) AS BIGINT) AS failures"""


def _not_null(model: str, column: str) -> str:
    return _check(model, column, "not_null", f"SELECT count(*) FROM {model} WHERE {column} IS NULL")


def _repeats(model: str, columns: str, check: str, where: str = "", key: str = "") -> str:
    groups = f"{key}, {columns}" if key else columns
    repeated = f"SELECT {groups} FROM {model} {where} GROUP BY {groups} HAVING count(*) > 1"
    return _check(model, columns, check, f"SELECT count(*) FROM ({repeated})")


def _unique(model: str, column: str, key: str = "") -> str:
    return _repeats(model, column, "unique", f"WHERE {column} IS NOT NULL", key)


def _panel_checks(key: str) -> str:
    views = {"stg_smh_prices": "supplier_days", "fct_smh_q": "fact"}
    checks = []
    for model in views:
        checks += [_not_null(model, c) for c in NOT_NULL[model]]
        checks += [_unique(model, c, key) for c in UNIQUE[model]]
        if model in GRAIN:
            checks.append(_repeats(model, f"{key}, {GRAIN[model]}", "grain"))
    days = _target_days(key, "supplier_days")
    named = [f"{model} AS (SELECT * FROM {view})" for model, view in views.items()]
    return _with([*PANEL_FACT, days, *named], " UNION ALL ".join(checks))


def _checks(checks: list[str]) -> str:
    return _with([*FACT, _bank(), _matrix(), *_all_models()], " UNION ALL ".join(checks))


def _row_counts() -> str:
    counts = [f"SELECT '{model}' AS model, count(*) AS row_count FROM {model}" for model in MODELS]
    return _with([*FACT, _bank(), _matrix(), *_all_models()], " UNION ALL ".join(counts))


def _declared(check, contract: dict[str, list[str]]) -> list[str]:
    return [check(model, column) for model, columns in contract.items() for column in columns]


def _per_desk(sql: str) -> str:
    """The query of one series over a third of the orders and their lines at a time."""
    parts = []
    for desk in range(3):
        own = sql
        for name, number in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            own = re.sub(rf"FROM {name}\b", f"FROM (SELECT * FROM {name} WHERE {number} % 3 = {desk})", own)
        parts.append(f"SELECT CAST({desk} AS BIGINT) AS desk, * FROM ({own})")
    return " UNION ALL ".join(parts)


_BANKED = [*FACT, _bank()]
_MATRIX = [*_BANKED, _matrix()]
_CELLS = [*_MATRIX, _cells()]
_PANEL_CELLS = [*PANEL_FACT, _bank("l_suppkey"), _matrix("l_suppkey"), _cells("l_suppkey")]

_PAIRS = _pairs()

ORACLES: dict[str, str] = {
    "stage_prices": _with([TARGET_DAYS], _exact(PRICES, ["date", "volume"], "target_days")),
    "stage_benchmark": _with([BENCHMARK_DAYS], _exact(PRICES, ["date", "volume"], "benchmark_days")),
    "stage_observations": _with(
        [_ORDER_RECORDS], _exact(["value"], ["realtime_start", "realtime_end", "date"], "records")
    ),
    "stage_inventories": _staged_months(INVENTORY_MONTHS, "inventory_months"),
    "stage_new_orders": _staged_months(ORDER_MONTHS, "order_months"),
    "stage_ppi": _staged_months(PPI_MONTHS, "ppi_months"),
    "monthly_last_return": _monthly_prices(TARGET_DAYS, "target_days"),
    "monthly_last_return_benchmark": _monthly_prices(BENCHMARK_DAYS, "benchmark_days"),
    "monthly_change_inventory": _monthly_changes(INVENTORY_MONTHS, "inventory_months", "inventory", "inventory"),
    "monthly_change_orders": _monthly_changes(ORDER_MONTHS, "order_months", "new_orders", "new_orders"),
    "monthly_change_ppi": _monthly_changes(PPI_MONTHS, "ppi_months", "semiconductor_ppi", "ppi"),
    "quarter_last_price": _quarterly([TARGET_DAYS, TARGET_Q], "target_q", "smh_value", "smh", True),
    "quarter_last_benchmark": _quarterly([BENCHMARK_DAYS, BENCHMARK_Q], "benchmark_q", "sp500_value", "sp500", True),
    "quarter_last_inventory": _quarterly(
        [INVENTORY_MONTHS, INVENTORY_Q], "inventory_q", "quarterly_inventory", "inventory", True
    ),
    "quarter_sum_orders": _quarterly([ORDER_MONTHS, ORDERS_Q], "orders_q", "new_orders", "new_orders", False),
    "quarter_avg_ppi": _quarterly([PPI_MONTHS, PPI_Q], "ppi_q", "semiconductor_ppi", "ppi", False),
    "year_last_price": _yearly_last(TARGET_DAYS, "target_days"),
    "year_last_benchmark": _yearly_last(BENCHMARK_DAYS, "benchmark_days"),
    "year_december_inventory": _with(
        [INVENTORY_MONTHS, _YEAR_END], _rounded(["yearly_inventory", "inventory_yoy"], ["date", "year"], "changed")
    ),
    "year_sum_orders": _yearly_combined(ORDER_MONTHS, "order_months", _TOTAL, "new_orders", "new_orders_yoy"),
    "year_avg_ppi": _yearly_combined(
        PPI_MONTHS, "ppi_months", f"{_TOTAL} / count(value)", "semiconductor_ppi", "ppi_yoy"
    ),
    "fact_quarter": _with(FACT, FACT_SELECT),
    "fact_quarter_joined": _with(FACT, FACT_SELECT),
    "drop_latest_period": _with(QUARTERS, _STACKED),
    "spread_quarters": _with(
        QUARTERS,
        """SELECT year, quarter, year_quarter, round(sp500_value, 6) AS sp500_value,
                  round(sp500_yoy, 6) AS sp500_yoy, round(new_orders, 6) AS new_orders,
                  round(new_orders_yoy, 6) AS new_orders_yoy
           FROM benchmark_q FULL JOIN orders_q USING (year, quarter, year_quarter)""",
    ),
    "lag_bank": _with(
        _BANKED, _rounded(["smh_vs_sp500_yoy", "value", *LAGS], ["year", "quarter", "indicator"], "bank")
    ),
    "lag_correlation_wide": _with(_MATRIX, _rounded(list(LAGS), ["indicator"], "matrix")),
    "lag_correlation_long": _with(_CELLS, f"SELECT {CELL_SELECT} FROM cells"),
    "rank_drivers": _with([*_CELLS, _ranked()], f"SELECT {CELL_SELECT}, rank FROM ranked"),
    "rank_drivers_nan": _with(
        [*FACT, _GAPS, _bank(fact="gaps"), _matrix(), _cells(), _ranked()], f"SELECT {CELL_SELECT}, rank FROM ranked"
    ),
    "top_drivers": _with([*_CELLS, _ranked()], f"SELECT {CELL_SELECT} FROM ranked WHERE rank <= 2"),
    "latest_row": _with(FACT, f"{FACT_SELECT} QUALIFY date = max(date) OVER ()"),
    "kpi_row": _with([*_CELLS, _ranked()], "").rstrip() + "," + _kpi(),
    "kpi_row_from_tables": _with([*_CELLS, _ranked()], "").rstrip() + "," + _kpi(),
    "panel_quarter_change": _with(
        [SUPPLIER_Q], _rounded(["smh_value", "smh_qoq", "smh_yoy"], ["l_suppkey", "date", *PERIOD], "supplier_q")
    ),
    "panel_last_edge": _with(
        [EDGE_Q], "SELECT l_suppkey, date, year, quarter, year_quarter, smh_value FROM edge_q"
    ),
    "panel_monthly_return": _with(
        [_MONTH_PANEL], _rounded(["price", "monthly_return"], ["l_suppkey", "date", "month"], "changed")
    ),
    "panel_monthly_prices": _monthly_prices(_target_days("l_suppkey"), "target_days", "l_suppkey"),
    "panel_quarter_sum": _with(
        [_NATION_PANEL],
        _rounded(["new_orders", "new_orders_qoq", "new_orders_yoy"], ["c_nationkey", *PERIOD], "changed"),
    ),
    "pairs_correlation": f"{_PAIRS} SELECT l_suppkey, c_nationkey, lag_period, round(correlation, 6) AS correlation FROM cells",
    "pairs_strongest": f"""{_PAIRS} SELECT l_suppkey, c_nationkey, lag_period, round(correlation, 6) AS correlation,
        row_number() OVER (ORDER BY round(abs(correlation), 12) DESC, l_suppkey, c_nationkey, lag_period) AS rank
        FROM cells QUALIFY rank <= 50""",
    "panel_fact": _with(PANEL_FACT, _rounded(FACT_MEASURES, ["l_suppkey", "date", *PERIOD], "fact")),
    "panel_lag_correlation": _with(_PANEL_CELLS, f"SELECT l_suppkey, {CELL_SELECT} FROM cells"),
    "panel_rank_drivers": _with(
        [*_PANEL_CELLS, _ranked("l_suppkey")], f"SELECT l_suppkey, {CELL_SELECT}, rank FROM ranked"
    ),
    "panel_rank_overall": _with(
        _PANEL_CELLS,
        f"""SELECT l_suppkey, {CELL_SELECT}, row_number() OVER (
                ORDER BY abs(round(correlation, 12)) DESC, indicator, lag_period, l_suppkey) AS rank
            FROM cells WHERE correlation IS NOT NULL""",
    ),
    "panel_kpi": _with([*_PANEL_CELLS, _ranked("l_suppkey")], "").rstrip() + "," + _kpi("l_suppkey"),
    "row_change_long_series": _with(
        [_LINE_CHANGES],
        _rounded(
            ["price", "change_1", "change_12"],
            ["l_returnflag", "date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
            "changed",
        ),
    ),
    "land_chart_payload": _CHART_ROWS,
    "land_observation_payload": _with(
        [_ORDER_RECORDS], _rounded(["value"], ["series_id", "realtime_start", "realtime_end", "date"], "records")
    ),
    "land_report": _REPORT,
    "refresh_models": _row_counts(),
    "refresh_fact": _with(FACT, FACT_SELECT),
    "refresh_correlation": _with(_MATRIX, _rounded(list(LAGS), ["indicator"], "matrix")),
    "refresh_kpi": _with([*_CELLS, _ranked()], "").rstrip() + "," + _kpi(),
    "refresh_after_revision": _with(FACT, FACT_SELECT),
    "refresh_snapshot": (_with([*_CELLS, _ranked()], "").rstrip() + "," + _kpi()).removesuffix("FROM latest")
    + ", (SELECT count(*) FROM fact) AS quarters FROM latest",
    "refresh_bucketed_fact": _per_desk(_with(FACT, FACT_SELECT)),
    "refresh_panel_kpi": _per_desk(_with([*_CELLS, _ranked()], "").rstrip() + "," + _kpi()),
    "dq_not_null": _checks(_declared(_not_null, NOT_NULL)),
    "dq_unique": _checks(_declared(_unique, UNIQUE)),
    "dq_grain": _checks(
        [
            *(_repeats(model, grain, "grain") for model, grain in GRAIN.items()),
            *(
                _check(model, "*", "row_count", f"SELECT abs(count(*) - {n}) FROM {model}")
                for model, n in ROW_COUNT.items()
            ),
        ]
    ),
    "dq_panel": _panel_checks("l_suppkey"),
    "dq_order_records": _with(
        [_ORDER_RECORDS, "stg_fred_new_orders AS (SELECT * FROM records)"],
        " UNION ALL ".join(
            [
                *(_not_null("stg_fred_new_orders", c) for c in NOT_NULL["stg_fred_new_orders"]),
                *(_unique("stg_fred_new_orders", c) for c in UNIQUE["stg_fred_new_orders"]),
            ]
        ),
    ),
    "dq_unique_records": " UNION ALL ".join(
        [_unique("orders", "o_orderkey"), _unique("orders", "o_custkey"), _unique("lineitem", "l_linenumber", "l_orderkey")]
    ),
}
