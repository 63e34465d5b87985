"""Read patterns over labelled bars: joins, summaries, rankings, calendars, runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barstats.functions import month_start
from barstats.operators.intraday import DAY, VOL_WINDOW
from barstats.operators.rules import LABELS
from barstats.schema import ROW_ID, SYMBOL, TS


def intraday_returns(
    bars: DataFrame, anomalies: DataFrame, key: Sequence[str] = (ROW_ID, SYMBOL, TS)
) -> DataFrame:
    """Bars with the row of the anomaly table for the same bar.

    The row id is part of the key: a symbol may have several bars at an instant.
    Both sides have a row per bar, so the join is left to Spark: a sort-merge join
    on a near-unique key, which skew on the symbol alone does not upset.
    """
    shared = [c for c in anomalies.columns if c in bars.columns and c not in key]
    return bars.join(anomalies.drop(*shared), list(key), "inner")


def daily_summary(df: DataFrame, ts: str = TS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """OHLC, volume, mean volatility and label counts per symbol and day.

    A tie-break is only for bars of equal time: it makes Spark sort before it
    aggregates, where the time alone is aggregated by hashing.
    """
    at = F.struct(ts, *tiebreak) if tiebreak else F.col(ts)
    return df.groupBy(SYMBOL, DAY).agg(
        F.min_by("open", at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", at).alias("close"),
        F.sum("volume").alias("volume"),
        F.avg(f"realized_vol_{VOL_WINDOW}").alias("avg_realized_vol"),
        *[F.count_if(F.col("anomaly_label") == n).alias(f"{n}_bars") for n in LABELS],
    )


def anomalies_ranked(df: DataFrame, top: int = 10, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The ``top`` labelled bars of each day by score; the limit is pushed to the map side."""
    order = Window.partitionBy(DAY).orderBy(F.desc("anomaly_score"), TS, SYMBOL, *tiebreak)
    return (
        df.where(F.col("anomaly_label") != LABELS[0])
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )


def anomaly_calendar(df: DataFrame) -> DataFrame:
    """Labelled bars per day and label, in long form."""
    return (
        df.where(F.col("anomaly_label") != LABELS[0])
        .groupBy(DAY, "anomaly_label")
        .agg(F.count("*").alias("anomaly_count"))
    )


def label_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(month_start(F.col(DAY)).alias("month"), "anomaly_label").agg(
        F.count("*").alias("bars")
    )


def run_compare(df: DataFrame) -> DataFrame:
    """Flag counts and the spread of scores per run."""
    return df.groupBy("run_id").agg(
        F.count("*").alias("bars"),
        *[F.count_if(F.col("anomaly_label") == n).alias(f"{n}_bars") for n in LABELS[1:]],
        F.avg("anomaly_score").alias("mean_score"),
        F.stddev_samp("anomaly_score").alias("std_score"),
        F.max("anomaly_score").alias("max_score"),
    )
