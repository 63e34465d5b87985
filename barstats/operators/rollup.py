"""A kept summary by symbol and day, to which new days are added.

A row holds what can be merged: counts, sums, extremes, the first and last bar, the count, mean and
squared deviations of each measure, and a sketch of the distribution of one. It is written
by day, so that days which arrive, or come again, replace their own rows and nothing else is
read or written. Daily and per-symbol results, and quantiles over any days, come from
these rows alone: one per symbol and day, whatever the number of bars.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barstats.functions import month_start, ratio, trading_day
from barstats.schema import IQR_FLAG, IQR_K, RELATIVE_ERROR, SYMBOL, TS, Z_FLAG
from barstats.sources.layout import DAY, load_table

MEASURES = ("close", "simple_return")
SKETCH = "sketch"
_MOST_K = 65_535


def sketch_size(relative_error: float) -> int:
    """The parameter of a sketch whose ranks are within the error.

    The published bound for two ranks at once is 2.446 / k ** 0.9433 with 99 % confidence; half the error is
    asked for, which leaves a miss out of practical reach.
    """
    if not 0 < relative_error <= 1:
        raise ValueError(f"a sketch needs a relative_error above 0 and up to 1, got {relative_error}")
    size = ceil((2.446 / (relative_error / 2)) ** (1 / 0.9433))
    if size > _MOST_K:
        raise ValueError(f"no sketch is as exact as {relative_error}")
    return max(8, size)


def moments(column: str) -> Column:
    """n, mean and squared deviations of a column, NULL and NaN left out."""
    x = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    n = F.count(x)
    return F.struct(
        n.alias("n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("m2"), F.min(x).alias("lo"), F.max(x).alias("hi"),
    )


def merged_moments(parts: Column) -> Column:
    """n, mean and squared deviations of all the rows behind an array of such structs."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        share = F.coalesce(ratio(b["n"].cast("double"), n.cast("double")), F.lit(0.0))
        apart = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * share).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"),
        )

    return F.aggregate(parts, zero, add)


@dataclass(frozen=True)
class Rollup:
    """The table at ``path``. ``tiebreak`` orders bars of a symbol that share a time."""

    path: str
    measures: Sequence[str] = MEASURES
    sketched: str = "close"
    relative_error: float = RELATIVE_ERROR
    ts: str = TS
    z_flag: str = Z_FLAG
    iqr_flag: str = IQR_FLAG
    tiebreak: Sequence[str] = ()

    def partials(self, bars: DataFrame) -> DataFrame:
        """A row per symbol and day, combined map-side."""
        at = F.struct(self.ts, *self.tiebreak)
        z, iqr = (F.coalesce(F.col(c), F.lit(False)) for c in (self.z_flag, self.iqr_flag))
        drawn = F.col(self.sketched).cast("double")
        timed = bars.where(F.col(self.ts).isNotNull())
        return timed.groupBy(trading_day(F.col(self.ts)).alias(DAY), SYMBOL).agg(
            F.count("*").alias("bars"),
            F.sum("volume").alias("volume"),
            F.min_by("open", at).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", at).alias("close"),
            F.count_if(z).alias("zscore"),
            F.count_if(iqr).alias("iqr"),
            F.count_if(z | iqr).alias("either"),
            F.struct(*[moments(m).alias(m) for m in self.measures]).alias("measures"),
            F.kll_sketch_agg_double(
                F.when(~F.isnan(drawn), drawn), F.lit(sketch_size(self.relative_error))
            ).alias(SKETCH),
        )

    def add(self, bars: DataFrame) -> None:
        """Summarise whole days of bars; their rows replace those of the same days."""
        load_table(
            self.partials(bars), self.path, "overwrite", partition_field=DAY, only_days_written=True
        )

    def refresh(self, spark: SparkSession, lake: str, days: Sequence[dt.date | str]) -> None:
        """Summarise some days of a table written by day, reading their folders only."""
        held = [F.lit(d).cast("date") for d in days]
        self.add(spark.read.parquet(lake).where(F.col(DAY).isin(*held)))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


# --- results, all from the rows of a rollup ---------------------------------------


def daily_summary(rollup: DataFrame) -> DataFrame:
    """Open, high, low, close, volume and counts per day and symbol."""
    return rollup.select(DAY, SYMBOL, "bars", "open", "high", "low", "close", "volume", "zscore", "iqr", "either")


def daily_average(rollup: DataFrame, measure: str) -> DataFrame:
    """Mean of a measure per day and symbol, where it has a value."""
    part = F.col(f"measures.{measure}")
    return rollup.where(part["n"] > 0).select(DAY, SYMBOL, part["mean"].alias("mean"))


def daily_series(rollup: DataFrame, measure: str) -> DataFrame:
    """Mean of a measure per day over all symbols."""
    part = F.col(f"measures.{measure}")
    mean = ratio(F.sum(part["n"] * part["mean"]), F.sum(part["n"]).cast("double"))
    return rollup.groupBy(DAY).agg(mean.alias(measure)).where(F.col(measure).isNotNull())


def highest_volatility_symbols(rollup: DataFrame, limit: int = 10, measure: str = "simple_return") -> DataFrame:
    """The symbols with the largest sample deviation. The calendar bounds the parts of a symbol."""
    part = F.col(f"measures.{measure}")
    whole = rollup.where(part["n"] > 0).groupBy(SYMBOL).agg(merged_moments(F.collect_list(part)).alias("all"))
    variance = ratio(F.col("all.m2"), (F.col("all.n") - 1).cast("double"))
    return (
        whole.select(SYMBOL, F.sqrt(variance).alias("return_volatility"), F.col("all.n").alias("observations"))
        .orderBy(F.desc_nulls_last("return_volatility"), SYMBOL)
        .limit(int(limit))
    )


def top_anomaly_days(rollup: DataFrame, detector: str = "iqr", limit: int = 10) -> DataFrame:
    """The (day, symbol) pairs that a detector (zscore, iqr or either) flags most."""
    counts = rollup.select(DAY, SYMBOL, F.col(detector).alias("anomaly_count"))
    ordered = counts.where(F.col("anomaly_count") > 0).orderBy(F.desc("anomaly_count"), DAY, SYMBOL)
    return ordered.limit(int(limit))


def rolling_anomaly_counts(rollup: DataFrame, detector: str = "iqr", window_days: int = 7) -> DataFrame:
    """Flags per day and symbol, and over the last days that have bars."""
    recent = Window.partitionBy(SYMBOL).orderBy(DAY).rowsBetween(1 - int(window_days), 0)
    counts = rollup.select(DAY, SYMBOL, F.col(detector).alias("anomaly_count"))
    return counts.withColumn("rolling_anomaly_count", F.sum("anomaly_count").over(recent))


def monthly_anomaly_counts(rollup: DataFrame) -> DataFrame:
    """Flags per month and detector, months without any included."""
    return rollup.groupBy(month_start(F.col(DAY)).alias("month")).agg(
        F.sum("zscore").alias("zscore"), F.sum("iqr").alias("iqr")
    )


def top_days_combined(rollup: DataFrame, limit: int = 20) -> DataFrame:
    """The days with most bars that either detector flags, all symbols together."""
    days = rollup.groupBy(DAY).agg(F.sum("either").alias("anomaly_count"))
    return days.where(F.col("anomaly_count") > 0).orderBy(F.desc("anomaly_count"), DAY).limit(int(limit))


def merged_quantiles(rollup: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and ``quantiles`` over all days in the table, from their sketches."""
    whole = rollup.groupBy(*by).agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH))
    n = F.kll_sketch_get_n_double(SKETCH)
    found = F.array(*[F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))) for p in probs])
    return whole.where(n > 0).select(*by, n.alias("n"), found.alias("quantiles"))


def iqr_bounds_merged(rollup: DataFrame, k: float = IQR_K, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n``, ``q1``, ``q3`` and the fences ``lower`` and ``upper``."""
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    reach = F.lit(float(k)) * (q3 - q1)
    return merged_quantiles(rollup, (0.25, 0.75), by).select(
        *by, "n", q1.alias("q1"), q3.alias("q3"), (q1 - reach).alias("lower"), (q3 + reach).alias("upper")
    )
