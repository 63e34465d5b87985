"""Cleaning raw bars: copies, time text, gaps, order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstats.functions import parse_bar_time
from barstats.schema import RAW_COLUMNS, TS


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of every set of wholly equal rows (copies are combined map-side)."""
    return df.dropDuplicates()


def parse_time(df: DataFrame, ts: str = TS) -> DataFrame:
    """Replace the time text by wall-clock time; text out of format becomes NULL."""
    return df.withColumn(ts, parse_bar_time(F.col(ts)))


def drop_incomplete(df: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Keep the rows with neither NULL nor NaN in ``columns``."""
    return df.dropna(how="any", subset=list(columns))


def sort_by_time(df: DataFrame, ts: str = TS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Order for showing or writing. A tie-break lets Spark split a crowded instant."""
    return df.orderBy(ts, *tiebreak)


def clean(df: DataFrame, *, sort: bool = True, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Drop copies, parse the time, drop incomplete rows, sort.

    Windows impose their own order, so a pipeline asks for ``sort=False`` and
    saves a shuffle.
    """
    complete = df.transform(drop_copies).transform(parse_time).transform(drop_incomplete)
    return sort_by_time(complete, tiebreak=tiebreak) if sort else complete


def between_times(df: DataFrame, start, end, ts: str = TS) -> DataFrame:
    """Rows with ``start <= ts <= end``. An end without a time of day is its midnight."""
    low, high = (F.lit(str(t)).cast("timestamp_ntz") for t in (start, end))
    return df.where(F.col(ts).between(low, high))


def flagged(df: DataFrame, flag: str, value: bool = True) -> DataFrame:
    """Rows whose flag is TRUE (or FALSE); a NULL flag is in neither."""
    return df.where(F.col(flag) if value else ~F.col(flag))
