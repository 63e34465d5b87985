"""Expressions that give the same value with ANSI mode on or off, in any time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Fixed value: the bar time format of the input files, two blanks between day and time.
BAR_TIME_FORMAT = "yyyyMMdd  HH:mm:ss"
_BAR_TIME_SHAPE = r"^[0-9]{8}  [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient that is NULL over zero."""
    return F.try_divide(numerator, denominator)


def parse_bar_time(text: Column) -> Column:
    """Bar time text as wall-clock time; NULL when it is not in the format."""
    iso = F.concat(
        F.substring(text, 1, 4),
        F.lit("-"),
        F.substring(text, 5, 2),
        F.lit("-"),
        F.substring(text, 7, 2),
        F.lit(" "),
        F.substring(text, 11, 8),
    )
    return F.when(text.rlike(_BAR_TIME_SHAPE), iso.try_cast("timestamp_ntz"))


def format_bar_time(ts: Column) -> Column:
    return F.date_format(ts, BAR_TIME_FORMAT)


def wall_clock(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def trading_day(ts: Column) -> Column:
    return F.to_date(ts)


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, DoubleType | FloatType):
        missing = missing | F.isnan(name)
    return missing
