from lagscope.operators.align import align_left, drop_latest, relative, spread_series, stack_series
from lagscope.operators.change import with_changes, with_lags
from lagscope.operators.correlation import (
    correlation,
    correlation_cells,
    lag_bank,
    lag_correlation,
    whole,
    whole_correlation,
)
from lagscope.operators.long_series import with_changes_any_length, with_lags_any_length, with_positions
from lagscope.operators.pairs import pair_correlations, strongest_pairs
from lagscope.operators.quality import (
    failures_from_states,
    failures_in_one_pass,
    grain_failures,
    load_report,
    not_null_failures,
    row_count_failures,
    unique_failures,
)
from lagscope.operators.ranking import (
    driver_columns,
    latest_rows,
    nth_driver_columns,
    rank_by_strength,
    rank_overall,
    strongest_first,
    top_drivers,
)
from lagscope.operators.resample import last_rows, resample, resample_by_rule
from lagscope.operators.states import PeriodStates, month_states
from lagscope.operators.uniqueness import repeated_values, unique_failures_of_repeats

__all__ = [
    "PeriodStates",
    "align_left",
    "correlation",
    "correlation_cells",
    "driver_columns",
    "drop_latest",
    "failures_from_states",
    "failures_in_one_pass",
    "grain_failures",
    "lag_bank",
    "lag_correlation",
    "last_rows",
    "latest_rows",
    "load_report",
    "month_states",
    "not_null_failures",
    "nth_driver_columns",
    "pair_correlations",
    "rank_by_strength",
    "rank_overall",
    "relative",
    "repeated_values",
    "resample",
    "resample_by_rule",
    "row_count_failures",
    "spread_series",
    "stack_series",
    "strongest_first",
    "strongest_pairs",
    "top_drivers",
    "unique_failures",
    "unique_failures_of_repeats",
    "whole",
    "whole_correlation",
    "with_changes",
    "with_changes_any_length",
    "with_lags",
    "with_lags_any_length",
    "with_positions",
]
