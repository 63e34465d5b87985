"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores. Every query
is run once to warm up and once for the record, into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstats.operators import daily
from barstats.operators.iqr import detect_iqr_anomalies
from barstats.operators.rolling import add_rolling_stats
from barstats.operators.zscore import detect_zscore_anomalies
from barstats.plans.catalog import QUERIES
from barstats.plans.dashboard import charts
from barstats.plans.pipeline import enrich
from barstats.schema import IQR_FLAG, WINDOW
from barstats.sources.scratch import staged
from barstats.sources.tables import LINE_ORDER, series_from_lineitem

HEADLINE = (
    "flagship",
    "flagship_series",
    "rolling_stats",
    "detect_zscore",
    "detect_iqr",
    "detect_iqr_by_symbol",
    "top_anomaly_days",
    "rolling_anomaly_counts",
    "describe",
    "quarantine",
    "anomaly_rules",
    "vol_regime",
    "daily_summary",
    "anomalies_ranked",
    "sink_partitioned",
    "stream_zscore",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("barstats-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def enriched_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line as a bar, enriched: the table the chart aggregates read."""
    lines = series_from_lineitem(spark, folder).withColumns(
        {c: F.col("close") for c in ("open", "high", "low", "average")}
    )
    return staged(enrich(lines, tiebreak=LINE_ORDER), "bench")


def dashboard(table: DataFrame) -> None:
    """The data behind all nine charts."""
    for chart in charts(table).values():
        run(chart)


def on_rows(spark: SparkSession, folder: str, table: DataFrame) -> dict[str, DataFrame]:
    """The detectors and the five daily queries over every order line."""
    lines, ties = series_from_lineitem(spark, folder), {"tiebreak": LINE_ORDER}
    return {
        "rolling_stats_rows": add_rolling_stats(lines, "close", WINDOW, **ties),
        "detect_zscore_rows": detect_zscore_anomalies(
            add_rolling_stats(lines, "close", WINDOW, **ties), "close", WINDOW, 3.0
        ),
        "detect_iqr_rows": detect_iqr_anomalies(lines, "close", 1.5, 0.0),
        "avg_daily_return_rows": daily.average_daily_return(table),
        "top_volatility_symbols_rows": daily.highest_volatility_symbols(table),
        "top_anomaly_days_rows": daily.top_anomaly_days(table, IQR_FLAG),
        "daily_volume_rows": daily.daily_trading_volume(table),
        "rolling_anomaly_counts_rows": daily.rolling_anomaly_counts(table, IQR_FLAG),
    }


def timed(work) -> float:
    work()
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    table = enriched_lines(spark, folder)
    seconds = {"dashboard_9_charts": timed(lambda: dashboard(table))}
    for name in HEADLINE:
        seconds[name] = timed(lambda name=name: run(QUERIES[name](spark, folder)))
        print(name, seconds[name], file=sys.stderr, flush=True)
    for name, df in on_rows(spark, folder, table).items():
        seconds[name] = timed(lambda df=df: run(df))
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = sum(seconds.values())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
