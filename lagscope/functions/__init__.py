from lagscope.functions.arithmetic import percent_change, ratio
from lagscope.functions.casting import (
    epoch_nanos_to_date,
    safe_bigint,
    safe_date,
    safe_decimal,
)
from lagscope.functions.ordering import row_order
from lagscope.functions.periods import (
    PERIOD_COLUMNS,
    month_label,
    period_parts,
    quarter_label,
)

__all__ = [
    "PERIOD_COLUMNS",
    "epoch_nanos_to_date",
    "month_label",
    "percent_change",
    "period_parts",
    "quarter_label",
    "ratio",
    "row_order",
    "safe_bigint",
    "safe_date",
    "safe_decimal",
]
