"""Per-day analytics over the enriched table. Counts look at TRUE flags only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstats.functions import month_start, trading_day
from barstats.schema import IQR_FLAG, SYMBOL, TS, Z_FLAG

DAY = "trading_day"


def by_day(df: DataFrame, ts: str = TS):
    return df.groupBy(trading_day(F.col(ts)).alias(DAY), SYMBOL)


def average_daily_return(df: DataFrame) -> DataFrame:
    """Mean return per day and symbol, over the bars that have one."""
    return (
        by_day(df.where(F.col("simple_return").isNotNull()))
        .agg(F.avg("simple_return").alias("avg_return"))
        .orderBy(DAY, SYMBOL)
    )


def highest_volatility_symbols(df: DataFrame, limit: int = 10) -> DataFrame:
    """The symbols with the largest sample deviation of returns."""
    return (
        df.where(F.col("simple_return").isNotNull())
        .groupBy(SYMBOL)
        .agg(
            F.stddev_samp("simple_return").alias("return_volatility"),
            F.count("*").alias("observations"),
        )
        .orderBy(F.desc_nulls_last("return_volatility"), SYMBOL)
        .limit(int(limit))
    )


def daily_flag_counts(df: DataFrame, flag: str) -> DataFrame:
    return by_day(df).agg(F.count_if(F.col(flag)).alias("anomaly_count"))


def top_anomaly_days(df: DataFrame, anomaly_column: str, limit: int = 10) -> DataFrame:
    """The (day, symbol) pairs with most flags; earlier day, then symbol, breaks ties."""
    return (
        daily_flag_counts(df, anomaly_column)
        .where(F.col("anomaly_count") > 0)
        .orderBy(F.desc("anomaly_count"), DAY, SYMBOL)
        .limit(int(limit))
    )


def daily_trading_volume(df: DataFrame) -> DataFrame:
    return by_day(df).agg(F.sum("volume").alias("total_volume")).orderBy(DAY, SYMBOL)


def rolling_anomaly_counts(df: DataFrame, anomaly_column: str, window_days: int = 7) -> DataFrame:
    """Flags per day, and over the last ``window_days`` days that have bars.

    The window runs over one row per symbol and day, not over bars.
    """
    recent = Window.partitionBy(SYMBOL).orderBy(DAY).rowsBetween(1 - int(window_days), 0)
    return (
        daily_flag_counts(df, anomaly_column)
        .withColumn("rolling_anomaly_count", F.sum("anomaly_count").over(recent))
        .orderBy(SYMBOL, DAY)
    )


def daily_means(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of each column per calendar day; NULL where a day has no value."""
    return df.groupBy(*by, trading_day(F.col(TS)).alias(DAY)).agg(
        *[F.avg(c).alias(c) for c in columns]
    )


def daily_series(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Daily mean of one column, days without a value left out."""
    return daily_means(df, [column], by).where(F.col(column).isNotNull())


def price_trend(df: DataFrame, z_flag: str = Z_FLAG, iqr_flag: str = IQR_FLAG) -> DataFrame:
    """``series, at, value``: the daily mean close, and each detector's flagged bars."""
    daily = daily_series(df, "close").select(
        F.lit("daily_mean_close").alias("series"),
        F.col(DAY).cast("timestamp_ntz").alias("at"),
        F.col("close").alias("value"),
    )
    return daily.unionByName(flagged_bars(df, z_flag, iqr_flag))


def flagged_bars(df: DataFrame, z_flag: str = Z_FLAG, iqr_flag: str = IQR_FLAG) -> DataFrame:
    """``series, at, value``: the close of each detector's flagged bars."""
    detectors = F.array_compact(
        F.array(
            F.when(F.col(z_flag), F.lit("zscore_anomaly")),
            F.when(F.col(iqr_flag), F.lit("iqr_anomaly")),
        )
    )
    flagged = df.where(F.col(z_flag) | F.col(iqr_flag))
    return flagged.select(
        F.explode(detectors).alias("series"), F.col(TS).alias("at"), F.col("close").alias("value")
    )


def _flag_counts(df: DataFrame, period, name: str, z_flag: str, iqr_flag: str) -> DataFrame:
    return df.groupBy(period.alias(name)).agg(
        F.count_if(F.col(z_flag)).alias("zscore"), F.count_if(F.col(iqr_flag)).alias("iqr")
    )


def daily_anomaly_counts(
    df: DataFrame, z_flag: str = Z_FLAG, iqr_flag: str = IQR_FLAG
) -> DataFrame:
    """Flags per day and detector; days without any are left out."""
    counts = _flag_counts(df, trading_day(F.col(TS)), DAY, z_flag, iqr_flag)
    return counts.where(F.col("zscore") + F.col("iqr") > 0)


def monthly_anomaly_counts(
    df: DataFrame, z_flag: str = Z_FLAG, iqr_flag: str = IQR_FLAG
) -> DataFrame:
    """Flags per month and detector; months with bars but no flags stay."""
    return _flag_counts(df, month_start(F.col(TS)), "month", z_flag, iqr_flag)


def top_days_combined(
    df: DataFrame, limit: int = 20, z_flag: str = Z_FLAG, iqr_flag: str = IQR_FLAG
) -> DataFrame:
    """The days with most bars that either detector flags, all symbols together."""
    either = F.coalesce(F.col(z_flag), F.lit(False)) | F.coalesce(F.col(iqr_flag), F.lit(False))
    return (
        df.groupBy(trading_day(F.col(TS)).alias(DAY))
        .agg(F.count_if(either).alias("anomaly_count"))
        .where(F.col("anomaly_count") > 0)
        .orderBy(F.desc("anomaly_count"), DAY)
        .limit(int(limit))
    )
