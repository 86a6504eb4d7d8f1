from lagscope.sources.landing import (
    land,
    land_observed,
    land_series,
    materialize,
    materialize_observed,
    read_raw,
    read_series,
    refresh_table,
    store_buckets,
)
from lagscope.sources.payloads import read_chart_payloads, read_observation_payloads
from lagscope.sources.schemas import (
    CHART_PAYLOAD,
    OBSERVATION_PAYLOAD,
    RAW_OBSERVATIONS,
    RAW_PRICES,
)

__all__ = [
    "CHART_PAYLOAD",
    "OBSERVATION_PAYLOAD",
    "RAW_OBSERVATIONS",
    "RAW_PRICES",
    "land",
    "land_observed",
    "land_series",
    "materialize",
    "materialize_observed",
    "read_chart_payloads",
    "read_observation_payloads",
    "read_raw",
    "read_series",
    "refresh_table",
    "store_buckets",
]
