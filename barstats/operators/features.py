"""Scalar features of a bar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barstats.functions import ratio
from barstats.operators.blocks import over_series


def return_over(column: str, window: WindowSpec, bars: int = 1) -> Column:
    """Relative change against ``bars`` rows earlier; NULL without one, or over zero."""
    earlier = F.lag(column, bars).over(window)
    return ratio(F.col(column) - earlier, earlier)


def simple_return_stage(window: WindowSpec) -> dict[str, Column]:
    return {"simple_return": return_over("close", window)}


def add_simple_return(df: DataFrame, **series) -> DataFrame:
    """Change of the close since the previous bar of the series."""
    return over_series(df, 1, simple_return_stage, **series)


def price_range() -> Column:
    return F.col("high") - F.col("low")


def candle_body() -> Column:
    return F.col("close") - F.col("open")


def add_price_range(df: DataFrame) -> DataFrame:
    return df.withColumns({"price_range": price_range()})


def add_candle_body(df: DataFrame) -> DataFrame:
    """Signed: a bar that closes below its open has a negative body."""
    return df.withColumns({"candle_body": candle_body()})


def add_features(df: DataFrame, **series) -> DataFrame:
    return add_simple_return(df, **series).withColumns(
        {"price_range": price_range(), "candle_body": candle_body()}
    )


def add_rolling_return(df: DataFrame, column: str = "close", bars: int = 20, **series) -> DataFrame:
    """Change of ``column`` over ``bars`` rows, as ``{column}_return_{bars}``."""
    if bars < 1:
        raise ValueError(f"bars must be at least 1, got {bars}")
    return over_series(
        df, bars, lambda w: {f"{column}_return_{bars}": return_over(column, w, bars)}, **series
    )
