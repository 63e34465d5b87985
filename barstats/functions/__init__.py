"""Column expressions shared by the operators."""

from barstats.functions.columns import (
    BAR_TIME_FORMAT,
    format_bar_time,
    is_missing,
    month_start,
    parse_bar_time,
    ratio,
    trading_day,
    wall_clock,
)
from barstats.functions.naming import (
    iqr_flag_name,
    mean_name,
    std_name,
    zscore_flag_name,
    zscore_name,
)

__all__ = [
    "BAR_TIME_FORMAT",
    "format_bar_time",
    "iqr_flag_name",
    "is_missing",
    "mean_name",
    "month_start",
    "parse_bar_time",
    "ratio",
    "std_name",
    "trading_day",
    "wall_clock",
    "zscore_flag_name",
    "zscore_name",
]
