"""Trailing statistics: over the current row and the ``size - 1`` rows before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barstats.functions import mean_name, std_name
from barstats.operators.blocks import Stage, over_series
from barstats.operators.wide import WideMoments

#: Frames of so many rows are put together of two parts; shorter ones are cheaper to go through.
WIDE = 128


def check_size(size: int) -> int:
    if size < 2:
        raise ValueError(f"a trailing window needs at least 2 rows, got {size}")
    return size


def trailing(window: WindowSpec, size: int) -> WindowSpec:
    return window.rowsBetween(1 - check_size(size), 0)


def moments_stage(
    value: str, size: int, *, mean: str | None = None, std: str | None = None, root_square: str | None = None
) -> Stage | WideMoments:
    """Columns of these names: mean, sample deviation, and root of the sum of squares.

    All skip NULLs and use what a short start offers. From WIDE rows on the frame is put
    together of two parts, which gives the same but for rounding.
    """
    check_size(size)
    if size >= WIDE:
        return WideMoments(value, size, mean, std, root_square)

    def stage(window: WindowSpec) -> dict[str, Column]:
        frame = trailing(window, size)
        added = {
            mean: F.avg(value).over(frame),
            std: F.stddev_samp(value).over(frame),
            root_square: F.sqrt(F.sum(F.col(value) * F.col(value)).over(frame)),
        }
        return {name: column for name, column in added.items() if name}

    return stage


def rolling_stage(column: str, size: int, *, mean: bool = True, std: bool = True) -> Stage | WideMoments:
    names = {"mean": mean_name(column, size) if mean else None, "std": std_name(column, size) if std else None}
    return moments_stage(column, size, **names)


def add_rolling_mean(df: DataFrame, column: str, window: int, **series) -> DataFrame:
    return over_series(df, window - 1, rolling_stage(column, window, std=False), **series)


def add_rolling_std(df: DataFrame, column: str, window: int, **series) -> DataFrame:
    return over_series(df, window - 1, rolling_stage(column, window, mean=False), **series)


def add_rolling_stats(df: DataFrame, column: str, window: int, **series) -> DataFrame:
    """Mean and deviation from one pass over the window."""
    return over_series(df, window - 1, rolling_stage(column, window), **series)
