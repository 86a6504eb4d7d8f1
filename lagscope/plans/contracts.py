"""Declared checks of every model."""

from __future__ import annotations

# Columns that must hold a value, and columns whose values must not repeat.
PRICE_FIELDS = ["date", "open", "high", "low", "close", "adjusted_close", "volume"]
OBSERVATION_FIELDS = ["realtime_start", "realtime_end", "date", "value"]
QUARTER_FIELDS = ["date", "year", "quarter", "year_quarter"]

NOT_NULL = {
    "stg_smh_prices": PRICE_FIELDS,
    "stg_sp500_prices": PRICE_FIELDS,
    "stg_fred_inventories": OBSERVATION_FIELDS,
    "stg_fred_new_orders": OBSERVATION_FIELDS,
    "stg_fred_semiconductor_ppi": OBSERVATION_FIELDS,
    "int_smh_prices": [*PRICE_FIELDS, "month"],
    "int_sp500_prices": [*PRICE_FIELDS, "month"],
    "int_fred_inventories": ["date", "month", "inventory"],
    "int_fred_new_orders": ["date", "month", "new_orders"],
    "int_fred_semiconductor_ppi": ["date", "month", "semiconductor_ppi"],
    "int_smh_yearly": ["year", "date", "adjusted_close"],
    "int_sp500_yearly": ["year", "date", "adjusted_close"],
    "int_fred_new_orders_yearly": ["year", "new_orders"],
    "int_fred_ppi_yearly": ["year", "semiconductor_ppi"],
    "int_smh_q": [*QUARTER_FIELDS, "smh_value"],
    "int_sp500_q": [*QUARTER_FIELDS, "sp500_value"],
    "int_fred_inventories_q": [*QUARTER_FIELDS, "quarterly_inventory"],
    "int_fred_new_orders_q": ["year", "quarter", "year_quarter", "new_orders"],
    "int_fred_ppi_q": ["year", "quarter", "year_quarter", "semiconductor_ppi"],
    "fct_smh_q": [*QUARTER_FIELDS, "smh_value", "smh_qoq", "smh_yoy"],
    "fct_smh_q_correlation": ["indicator"],
    "fct_key_kpi": QUARTER_FIELDS,
}

UNIQUE = {
    "stg_smh_prices": ["date"],
    "stg_sp500_prices": ["date"],
    "stg_fred_inventories": ["date"],
    "stg_fred_new_orders": ["date"],
    "stg_fred_semiconductor_ppi": ["date"],
    "int_smh_prices": ["date", "month"],
    "int_sp500_prices": ["date", "month"],
    "int_fred_inventories": ["date", "month"],
    "int_fred_new_orders": ["date", "month"],
    "int_fred_semiconductor_ppi": ["date", "month"],
    "int_smh_yearly": ["year", "date"],
    "int_sp500_yearly": ["year", "date"],
    "int_fred_new_orders_yearly": ["year"],
    "int_fred_ppi_yearly": ["year"],
    "int_fred_inventories_yearly": ["year"],
    "int_smh_q": ["date", "year_quarter"],
    "int_sp500_q": ["date", "year_quarter"],
    "int_fred_inventories_q": ["date", "year_quarter"],
    "int_fred_new_orders_q": ["year_quarter"],
    "int_fred_ppi_q": ["year_quarter"],
    "fct_smh_q": ["date", "year_quarter"],
    "fct_smh_q_correlation": ["indicator"],
}

# The grain each stored table declares.
GRAIN = {
    "fct_smh_q": ["year_quarter"],
    "fct_smh_q_correlation": ["indicator"],
    "fct_key_kpi": ["year_quarter"],
}
ROW_COUNT = {"fct_key_kpi": 1}
