"""Features inside one trading day: no window looks across midnight.

A day of one symbol is a series of its own here, so the same cutting into blocks
applies to a crowded day.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barstats.functions import ratio, trading_day
from barstats.operators.blocks import carry_cuts, over_series
from barstats.operators.quarantine import (
    SESSION_CLOSE_MINUTE,
    SESSION_OPEN_MINUTE,
    minute_of_day,
)
from barstats.operators.rolling import check_size, moments_stage, trailing
from barstats.operators.sliding import RowStage, above_quantile
from barstats.schema import SYMBOL, TS, WINDOW

DAY = "trading_day"
DAY_KEYS = (SYMBOL, DAY)

VOL_WINDOW = 60
REGIME_WINDOW = 390
REGIME_QUANTILE = 0.95
EWMA_LAMBDA = 0.94


def with_day(df: DataFrame, ts: str = TS) -> DataFrame:
    if DAY in df.columns:
        return df
    return carry_cuts(df, df.withColumn(DAY, trading_day(F.col(ts))))


def over_days(df: DataFrame, depth: int, *stages, **series) -> DataFrame:
    return over_series(with_day(df), depth, *stages, partition_cols=DAY_KEYS, **series)


def returns_stage(window: WindowSpec) -> Mapping[str, Column]:
    """Both returns; NULL on the first bar of the day and next to a price of zero."""
    change = ratio(F.col("close"), F.lag("close", 1).over(window))
    return {
        "log_return": F.when(change > 0, F.ln(change)),
        "simple_return": change - 1,
    }


def return_stats_stage(size: int = WINDOW):
    return moments_stage(
        "log_return", size, mean=f"rolling_mean_return_{size}", std=f"rolling_std_return_{size}"
    )


def realized_vol_stage(size: int = VOL_WINDOW):
    return moments_stage("log_return", size, root_square=f"realized_vol_{size}")


def volume_stats_stage(size: int = WINDOW):
    return moments_stage(
        "volume", size, mean=f"volume_rolling_mean_{size}", std=f"volume_rolling_std_{size}"
    )


def regime_stage(
    size: int = VOL_WINDOW, length: int = REGIME_WINDOW, quantile: float = REGIME_QUANTILE
) -> RowStage:
    """TRUE where volatility exceeds its own recent quantile."""
    return above_quantile(f"realized_vol_{size}", "is_volatility_regime", check_size(length), quantile)


def ewma_stage(size: int = WINDOW, decay: float = EWMA_LAMBDA):
    """Root of the weighted mean of the last ``size`` squared returns, newest heaviest."""
    squared = F.col("log_return") * F.col("log_return")

    def stage(window: WindowSpec) -> Mapping[str, Column]:
        recent = F.collect_list(squared).over(trailing(window, size))
        # Horner's rule over (weighted sum, sum of weights), oldest return first.
        totals = F.aggregate(
            recent,
            F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("weight")),
            lambda acc, x: F.struct(
                (acc["sum"] * decay + x).alias("sum"), (acc["weight"] * decay + 1).alias("weight")
            ),
        )
        return {f"ewma_vol_{size}": F.sqrt(ratio(totals["sum"], totals["weight"]))}

    return stage


def add_log_return(df: DataFrame, **series) -> DataFrame:
    return over_days(df, 1, returns_stage, **series)


def add_rolling_return_stats(df: DataFrame, size: int = WINDOW, **series) -> DataFrame:
    return over_days(df, size, returns_stage, return_stats_stage(size), **series)


def add_realized_vol(df: DataFrame, size: int = VOL_WINDOW, **series) -> DataFrame:
    return over_days(df, size, returns_stage, realized_vol_stage(size), **series)


def add_rolling_volume_stats(df: DataFrame, size: int = WINDOW, **series) -> DataFrame:
    return over_days(df, check_size(size) - 1, volume_stats_stage(size), **series)


def add_ewma_vol(
    df: DataFrame, size: int = WINDOW, decay: float = EWMA_LAMBDA, **series
) -> DataFrame:
    return over_days(df, size, returns_stage, ewma_stage(size, decay), **series)


def add_vol_regime(
    df: DataFrame,
    size: int = VOL_WINDOW,
    length: int = REGIME_WINDOW,
    quantile: float = REGIME_QUANTILE,
    **series,
) -> DataFrame:
    return over_days(
        df,
        size + length - 1,
        returns_stage,
        realized_vol_stage(size),
        regime_stage(size, length, quantile),
        **series,
    )


def add_session_features(df: DataFrame, ts: str = TS, edge: int = 5) -> DataFrame:
    """Minutes since the open, and whether the bar is in the first or last ``edge`` of them."""
    minute = minute_of_day(F.col(ts)) - SESSION_OPEN_MINUTE
    length = SESSION_CLOSE_MINUTE - SESSION_OPEN_MINUTE
    return df.withColumns(
        {
            "session_minute": minute,
            "is_session_open": (minute >= 0) & (minute < edge),
            "is_session_close": (minute >= length - edge) & (minute < length),
        }
    )


def add_intraday_features(
    df: DataFrame,
    size: int = WINDOW,
    vol_size: int = VOL_WINDOW,
    regime_length: int = REGIME_WINDOW,
    **series,
) -> DataFrame:
    """Every windowed intraday column from a single shuffle."""
    windowed = over_days(
        df,
        max(size, vol_size + regime_length - 1),
        returns_stage,
        return_stats_stage(size),
        realized_vol_stage(vol_size),
        volume_stats_stage(size),
        regime_stage(vol_size, regime_length),
        **series,
    )
    return add_session_features(windowed)
