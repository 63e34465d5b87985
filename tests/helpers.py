from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

START = datetime(2020, 1, 2, 9, 30)


def series(spark, closes, symbol="S", start=START):
    """One bar a minute with these closes."""
    rows = [(symbol, start + timedelta(minutes=i), i, c) for i, c in enumerate(closes)]
    return spark.createDataFrame(
        rows, "symbol string, date timestamp_ntz, row_index long, close double"
    )


def column(df, name, order="date"):
    return [row[name] for row in df.orderBy(order).collect()]


def same_rows(a, b):
    assert a.columns == b.columns
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def random_series(spark, n, hot_share=0.5, seed=3):
    """Symbols of very different length, gaps in the values, and repeated times."""
    hot = F.rand(seed) < hot_share
    return spark.range(n).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("symbol"),
        F.timestamp_micros(F.lit(1_577_957_400_000_000) + (F.rand(seed + 1) * n / 3).cast("long") * 60_000_000)
        .cast("timestamp_ntz")
        .alias("date"),
        F.col("id").alias("row_index"),
        F.when(F.rand(seed + 2) > 0.05, F.round(F.rand(seed + 4) * 100, 2)).alias("close"),
    )


def plain_window(*keys, tiebreak=("row_index",)):
    return Window.partitionBy(*keys).orderBy("date", *tiebreak)
