"""Bar tables made from general event and order-line tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barstats.functions import format_bar_time, ratio, wall_clock
from barstats.schema import KEYED_SCHEMA, SYMBOL, TS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _size() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def bars_from_events(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars per event type, one row index per bar: its first event's id.

    Events of one time are in the order of their ids.
    """
    order = F.struct("ts", "event_id")
    sized = table(spark, folder, "events").withColumn("_k", _size())
    hour = wall_clock(F.date_trunc("hour", "ts"))
    bars = sized.groupBy(F.col("event_type").alias(SYMBOL), hour.alias(TS)).agg(
        F.min("event_id").alias("row_index"),
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", order).alias("close"),
        F.sum("_k").alias("volume"),
        F.count("*").alias("barCount"),
        ratio(F.sum(F.col("value") * F.col("_k")), F.sum("_k").cast("double")).alias("average"),
    )
    return bars.select(*KEYED_SCHEMA.names)


def as_raw(bars: DataFrame) -> DataFrame:
    """The same bars with their time as text, the way a file has them."""
    return bars.withColumn(TS, format_bar_time(F.col(TS)))


def raw_bars(spark: SparkSession, folder: str) -> DataFrame:
    return as_raw(bars_from_events(spark, folder))


def dirty_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with planted faults: lost times, gaps, a broken range, negative volumes, repeats."""
    i = F.col("row_index")
    bars = bars_from_events(spark, folder).withColumns(
        {
            TS: F.when(i % 47 != 0, F.col(TS)),
            "close": F.when(i % 50 != 0, F.col("close")),
            "high": F.when(i % 51 == 0, F.col("low") - 1).otherwise(F.col("high")),
            "volume": F.when(i % 53 == 0, -1 - F.col("volume")).otherwise(F.col("volume")),
        }
    )
    return bars.unionByName(bars.where(i % 40 == 0))


def ticks_from_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a one-trade bar of its type."""
    value = F.col("value")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("row_index"),
        F.col("ts").alias(TS),
        *[value.alias(p) for p in ("open", "high", "low", "close")],
        _size().alias("volume"),
        F.lit(1).cast("long").alias("barCount"),
        value.alias("average"),
        F.col("event_type").alias(SYMBOL),
    )


LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def series_from_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines of a supplier as a price series; ties are broken by LINE_ORDER."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias(SYMBOL),
        F.col("l_shipdate").alias(TS),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
        *[c for c in LINE_ORDER],
    )
