"""Bars that break a rule are set aside with a reason; none is dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstats.functions import is_missing, parse_bar_time, trading_day
from barstats.schema import ROW_ID, SYMBOL, TS

PRICES = ("open", "high", "low", "close")

# Reasons in the order in which they are tried, and the session.
REASONS = ("bad_timestamp", "null_ohlcv", "ohlc_invariant", "negative_count", "extended_hours")
SESSION_OPEN_MINUTE = 9 * 60 + 30
SESSION_CLOSE_MINUTE = 16 * 60


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def ingest_normalise(df: DataFrame, ts: str = TS) -> DataFrame:
    """``timestamp``, ``trading_day`` and snake-case ``bar_count`` from a raw bar table."""
    when = parse_bar_time(F.col(ts)) if dict(df.dtypes)[ts] == "string" else F.col(ts)
    return (
        df.withColumn(ts, when)
        .withColumn("trading_day", trading_day(F.col(ts)))
        .withColumnsRenamed({ts: "timestamp", "barCount": "bar_count"})
    )


def dedupe_by_ts(
    df: DataFrame,
    ts: str = TS,
    partition_cols: Sequence[str] = (SYMBOL,),
    order: Sequence[str] = (ROW_ID,),
) -> DataFrame:
    """Keep the first bar of each instant; a bar without a time is no instant, and stays.

    The limit on the rank is pushed to the map side. Bars without a time are groups of
    their own, so however many there are, they are spread.
    """
    alone = F.when(F.col(ts).isNull(), F.monotonically_increasing_id())
    same = Window.partitionBy(*partition_cols, ts, "_alone").orderBy(*order)
    ranked = df.withColumn("_alone", alone).withColumn("_nth", F.row_number().over(same))
    return ranked.where("_nth = 1").drop("_nth", "_alone")


def keeps_invariants() -> Column:
    low, high, body = F.col("low"), F.col("high"), (F.col("open"), F.col("close"))
    return (
        (high >= F.greatest(*body))
        & (low <= F.least(*body))
        & (high >= low)
        & (F.least(*[F.col(p) for p in PRICES]) > 0)
    )


def in_session(ts: Column) -> Column:
    minute = minute_of_day(ts)
    return (minute >= SESSION_OPEN_MINUTE) & (minute < SESSION_CLOSE_MINUTE)


def add_reason(df: DataFrame, ts: str = TS, bar_count: str = "barCount") -> DataFrame:
    """The first rule a bar breaks, as ``reason``; NULL for a good bar."""
    missing = is_missing(df, "volume")
    for p in PRICES:
        missing = missing | is_missing(df, p)
    broken = (
        F.col(ts).isNull(),
        missing,
        ~keeps_invariants(),
        (F.col("volume") < 0) | (F.coalesce(F.col(bar_count), F.lit(0)) < 0),
        ~in_session(F.col(ts)),
    )
    reason = F.lit(None).cast("string")
    for name, rule in reversed(list(zip(REASONS, broken, strict=True))):
        reason = F.when(rule, F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def good_bars(df: DataFrame) -> DataFrame:
    return df.where(F.col("reason").isNull()).drop("reason")


def quarantined(df: DataFrame) -> DataFrame:
    return df.where(F.col("reason").isNotNull())


def quarantine_metrics(df: DataFrame, ingested: DataFrame | None = None) -> DataFrame:
    """``reason, rows_quarantined, rows_in, rows_out``: a row per reason, used or not.

    With the table before its repeated instants were dropped, ``rows_in`` counts that, and
    ``collisions`` the bars that were dropped.
    """
    counts = df.agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("reason").isNull()).alias("rows_out"),
        *[F.count_if(F.col("reason") == r).alias(f"_{r}") for r in REASONS],
    )
    lines = [
        F.struct(F.lit(r).alias("reason"), F.col(f"_{r}").alias("rows_quarantined"))
        for r in REASONS
    ]
    if ingested is None:
        return counts.select("rows_in", "rows_out", F.inline(F.array(*lines)))
    before = ingested.agg(F.count("*")).scalar()
    counts = counts.withColumn("_before", before)
    collisions = (F.col("_before") - F.col("rows_in")).alias("collisions")
    return counts.select(
        F.col("_before").alias("rows_in"), collisions, "rows_out", F.inline(F.array(*lines))
    )
