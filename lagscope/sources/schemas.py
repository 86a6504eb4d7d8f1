"""Schemas of landed payloads and raw tables; nothing is inferred from data."""

from __future__ import annotations

# The fields of the two providers' payloads and of the raw tables.
CHART_PAYLOAD = """
    chart struct<result: array<struct<
        timestamp: array<bigint>,
        indicators: struct<
            quote: array<struct<
                open: array<double>, high: array<double>, low: array<double>,
                close: array<double>, volume: array<double>>>,
            adjclose: array<struct<adjclose: array<double>>>>>>>
"""

OBSERVATION_PAYLOAD = """
    observations array<struct<
        realtime_start: string, realtime_end: string, date: string, value: string>>
"""

# date counts nanoseconds since 1970. Files of other writers may hold volume as bigint: read
# those without a schema, and staging takes either.
RAW_PRICES = "date bigint, open double, high double, low double, close double, adj_close double, volume double"

RAW_OBSERVATIONS = "realtime_start string, realtime_end string, date string, value string"

NANOS_PER_SECOND = 1_000_000_000
