"""The data of all nine charts from one summary by day and one pass for each picture of bars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstats.functions import month_start, trading_day
from barstats.operators import daily, histograms, profile
from barstats.schema import CORRELATION_FEATURES, IQR_FLAG, TS, WINDOW, Z_FLAG
from barstats.sources.scratch import staged

DAY = daily.DAY
Z = f"close_zscore_{WINDOW}"
ROLLED = [f"close_rolling_mean_{WINDOW}", f"close_rolling_std_{WINDOW}"]
_MEANS = ("close", Z, *ROLLED)


def daily_rollup(table: DataFrame) -> DataFrame:
    """A row per calendar day: means, flag counts, and what ranges and overall means need."""
    z, iqr = (F.coalesce(F.col(c), F.lit(False)) for c in (Z_FLAG, IQR_FLAG))
    close = F.nanvl(F.col("close").cast("double"), F.lit(None).cast("double"))
    volume = F.when(F.col("volume") > 0, F.col("volume"))
    features = [
        F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in CORRELATION_FEATURES
    ]
    flagged = ((True, F.col(IQR_FLAG)), (False, ~F.col(IQR_FLAG)))
    return table.groupBy(trading_day(F.col(TS)).alias(DAY)).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in _MEANS],
        F.count_if(z).alias("zscore"),
        F.count_if(iqr).alias("iqr"),
        F.count_if(z | iqr).alias("either"),
        *[F.min(F.when(w, close)).alias(f"least_{f}") for f, w in flagged],
        *[F.max(F.when(w, close)).alias(f"greatest_{f}") for f, w in flagged],
        F.min(volume).alias("least_volume"),
        F.max(volume).alias("greatest_volume"),
        *[F.sum(c).alias(f"sum_{i}") for i, c in enumerate(features)],
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(features)],
    )


def charts(
    table: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = staged
) -> dict[str, DataFrame]:
    """Name and data of each chart.

    The summary, a row per day, is kept (written out) once; five charts come from it alone. The
    others read the table once each: for flagged bars, two histograms and the correlation.
    """
    days = keep(daily_rollup(table), "days")

    def means(*columns: str) -> DataFrame:
        return days.select(DAY, *[F.col(f"mean_{c}").alias(c) for c in columns])

    def series(column: str) -> DataFrame:
        return means(column).where(F.col(column).isNotNull())

    def bounds(least: Column, greatest: Column) -> tuple[Column, Column]:
        return F.min(least).alias("least"), F.max(greatest).alias("greatest")

    by_flag = days.agg(
        *[F.struct(*bounds(F.col(f"least_{f}"), F.col(f"greatest_{f}"))).alias(f"f{f}") for f in (True, False)]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias(IQR_FLAG), F.col(f"f{f}.least").alias("least"), F.col(f"f{f}.greatest").alias("greatest"))
                    for f in (True, False)
                ]
            )
        )
    )
    volumes = days.agg(*bounds(F.log10("least_volume"), F.log10("greatest_volume")))
    overall = days.agg(
        *[(F.sum(f"sum_{i}") / F.sum(f"n_{i}")).alias(f"m{i}") for i in range(len(CORRELATION_FEATURES))]
    )
    trend = series("close").select(
        F.lit("daily_mean_close").alias("series"),
        F.col(DAY).cast("timestamp_ntz").alias("at"),
        F.col("close").alias("value"),
    )
    counts = days.select(DAY, "zscore", "iqr")
    return {
        "price_trend": trend.unionByName(daily.flagged_bars(table)),
        "daily_zscore": series(Z),
        "daily_rolling_stats": means(*ROLLED),
        "hist_close_by_iqr": histograms.histogram_by_flag(table, extremes=by_flag),
        "hist_log_volume": histograms.histogram_log(table, extremes=volumes),
        "feature_correlation": profile.correlation_matrix(table, means=overall),
        "daily_anomaly_counts": counts.where(F.col("zscore") + F.col("iqr") > 0),
        "monthly_anomaly_counts": counts.groupBy(month_start(F.col(DAY)).alias("month")).agg(
            F.sum("zscore").alias("zscore"), F.sum("iqr").alias("iqr")
        ),
        "top_days_combined": days.where(F.col("either") > 0)
        .select(DAY, F.col("either").alias("anomaly_count"))
        .orderBy(F.desc("anomaly_count"), DAY)
        .limit(20),
    }
