"""One query per operator, over tables made from the given ones.

Doubles that come out of sums are rounded here for comparison, never inside an
operator: ``round(x + 1e-9, 6) + 0.0`` is the same in any engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstats.functions import iqr_flag_name, zscore_name
from barstats.operators import clean as cleaning
from barstats.operators import daily, features, histograms, intraday, iqr, profile, rolling, rollup, views
from barstats.operators import quarantine as q
from barstats.operators.checks import data_quality_report
from barstats.operators.quantiles import exact_quantiles
from barstats.operators.rules import Rules, add_volume_zscore, apply_rules
from barstats.operators.zscore import (
    add_rolling_zscore,
    add_zscore_anomaly_flag,
    detect_zscore_anomalies,
)
from barstats.plans.pipeline import Settings, enrich, flagship, label_intraday, run_intraday
from barstats.schema import (
    ENRICHED_COLUMNS,
    IQR_FLAG,
    KEYED_SCHEMA,
    RAW_COLUMNS,
    RELATIVE_ERROR,
    SYMBOL,
    TS,
    WINDOW,
    Z_FLAG,
)
from barstats.sources import layout
from barstats.sources.bars import read_enriched, read_ohlcv_csv
from barstats.sources.scratch import new_folder, staged
from barstats.sources.tables import (
    LINE_ORDER,
    as_raw,
    bars_from_events,
    dirty_bars,
    raw_bars,
    series_from_lineitem,
    ticks_from_events,
)
from barstats.streaming.ingest import clean_stream, ingest_available, stream_raw_csv
from barstats.streaming.zscore import ZScoreStream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BY_ROW = {"tiebreak": ("row_index",)}
EXACT = Settings(relative_error=0.0)
ROLLED = (f"close_rolling_mean_{WINDOW}", f"close_rolling_std_{WINDOW}")
Z = zscore_name("close", WINDOW)
MEASURES = ("simple_return", "price_range", "candle_body", *ROLLED, Z)
DAY = daily.DAY


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) + F.lit(0.0) for c in columns})


def clean_bars(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(raw_bars(spark, folder), sort=False)


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return flagship(raw_bars(spark, folder), EXACT, **BY_ROW)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """The anomaly table, written once; the views read the columns they need of it."""
    return staged(label_intraday(ticks_from_events(spark, folder), **BY_ROW), "anomalies")


# --- the whole chain --------------------------------------------------------------


@query
def flagship_query(spark, folder):
    return rounded(enriched(spark, folder), "average", *MEASURES).select(*ENRICHED_COLUMNS)


QUERIES["flagship"] = QUERIES.pop("flagship_query")

# Blocks of about a hundred rows: short enough for the series of these tables to be cut.
SMALL_BLOCKS = {"sample_every": 4, "samples_per_block": 24}


@query
def flagship_blocks(spark, folder):
    """The whole chain with every series in many blocks."""
    out = flagship(raw_bars(spark, folder), EXACT, **BY_ROW, **SMALL_BLOCKS)
    return rounded(out, "average", *MEASURES).select(*ENRICHED_COLUMNS)


@query
def rolling_stats_blocks(spark, folder):
    ticks = ticks_from_events(spark, folder)
    out = rolling.add_rolling_stats(ticks, "close", 20, **BY_ROW, **SMALL_BLOCKS)
    return rounded(out, *ROLLED).select(*KEY, *ROLLED)


@query
def rolling_return_stats_blocks(spark, folder):
    """Day-scoped windows in blocks."""
    out = intraday.add_rolling_return_stats(
        ticks_from_events(spark, folder), **BY_ROW, sample_every=1, samples_per_block=25
    )
    names = ("rolling_mean_return_20", "rolling_std_return_20")
    return rounded(out, *names).select(*KEY, *names)


@query
def flagship_series(spark, folder):
    """The chain over every order line, a supplier being a series."""
    lines = series_from_lineitem(spark, folder).withColumns(
        {"open": F.col("close"), "high": F.col("close"), "low": F.col("close")}
    )
    out = enrich(lines, EXACT, tiebreak=LINE_ORDER)
    return rounded(out, "simple_return", *ROLLED, Z).select(
        SYMBOL, TS, *LINE_ORDER, "close", "simple_return", *ROLLED, Z, Z_FLAG, IQR_FLAG
    )


# --- sources and sinks ------------------------------------------------------------


@query
def scan_csv_bars(spark, folder):
    path = new_folder(spark, "csv")
    raw_bars(spark, folder).write.option("header", True).csv(path)
    return rounded(read_ohlcv_csv(path, spark, schema=KEYED_SCHEMA), "average")


@query
def scan_parquet(spark, folder):
    path = new_folder(spark, "enriched")
    layout.write_parquet(enriched(spark, folder), path)
    return rounded(read_enriched(path, spark), "average", *MEASURES).select(*ENRICHED_COLUMNS)


@query
def sink_parquet_roundtrip(spark, folder):
    """A second write replaces the first."""
    path = new_folder(spark, "roundtrip")
    bars = bars_from_events(spark, folder)
    layout.write_parquet(bars.where(F.col("volume") > 0), path)
    layout.write_parquet(bars, path)
    return rounded(read_enriched(path, spark), "average")


@query
def sink_partitioned(spark, folder):
    path = new_folder(spark, "by-day")
    layout.load_table(bars_from_events(spark, folder), path, mode="overwrite")
    return rounded(read_enriched(path, spark), "average")


@query
def sink_append(spark, folder):
    path = new_folder(spark, "appended")
    bars = bars_from_events(spark, folder)
    layout.load_table(bars, path, mode="overwrite")
    layout.load_table(bars, path, mode="append")
    return rounded(read_enriched(path, spark), "average")


@query
def sink_partition_overwrite(spark, folder):
    path = new_folder(spark, "by-day")
    bars = bars_from_events(spark, folder)
    layout.load_table(bars, path, mode="overwrite")
    later = bars.where(F.col(TS) >= F.lit("2024-01-16").cast("timestamp_ntz"))
    corrected = later.withColumn("volume", F.col("volume") + 1)
    layout.load_table(corrected, path, mode="overwrite", only_days_written=True)
    return rounded(read_enriched(path, spark), "average")


@query
def sink_upsert(spark, folder):
    """A third of the bars come once more with another volume, some of them twice, and the load is repeated."""
    path = new_folder(spark, "by-day")
    bars = bars_from_events(spark, folder)
    layout.upsert(bars.where("row_index % 4 > 0"), path)
    late = bars.where("row_index % 3 = 0 OR row_index % 4 = 0").withColumn("volume", F.col("volume") + 1)
    again = late.where("row_index % 6 = 0").withColumn("volume", F.col("volume") - 1)
    for _ in range(2):
        layout.upsert(late.unionByName(again), path, newest=("volume",))
    return rounded(read_enriched(path, spark), "average")


@query
def retention_filter(spark, folder):
    path = new_folder(spark, "by-day")
    layout.load_table(bars_from_events(spark, folder), path, mode="overwrite")
    layout.expire(spark, path, 10, as_of="2024-01-30")
    return rounded(read_enriched(path, spark), "average")


@query
def retained_days(spark, folder):
    """A read of the days that are kept, of a table that has them all."""
    path = new_folder(spark, "by-day")
    layout.load_table(bars_from_events(spark, folder), path, mode="overwrite")
    return rounded(layout.retained(read_enriched(path, spark), 10, as_of="2024-01-30"), "average")


@query
def run_summary(spark, folder):
    path = new_folder(spark, "summary")
    layout.load_with_summary(enriched(spark, folder), new_folder(spark, "by-day"), path, mode="overwrite")
    schema = (
        "processed_row_count long, symbols long, zscore_anomalies long, iqr_anomalies long,"
        " first_bar timestamp_ntz, last_bar timestamp_ntz"
    )
    return spark.read.schema(schema).json(path)


# --- checks and cleaning ----------------------------------------------------------


@query
def dq_report(spark, folder):
    path = new_folder(spark, "csv")
    raw_bars(spark, folder).write.option("header", True).csv(path)
    scanned = read_ohlcv_csv(path, spark, schema=KEYED_SCHEMA)
    return data_quality_report(scanned, KEYED_SCHEMA)


@query
def dq_report_faults(spark, folder):
    """A table with an absent column, a wrong type and lost times."""
    bars = dirty_bars(spark, folder).drop("average").withColumn("close", F.col("close").cast("string"))
    return data_quality_report(bars, KEYED_SCHEMA)


@query
def profile_shape(spark, folder):
    return profile.shape(bars_from_events(spark, folder))


@query
def clean_dedupe(spark, folder):
    raw = raw_bars(spark, folder)
    repeated = raw.unionByName(raw.where(F.col("row_index") % 3 == 0))
    return rounded(cleaning.drop_copies(repeated), "average")


@query
def clean_parse_ts(spark, folder):
    """Every seventh bar has its time in a format that does not parse."""
    raw = raw_bars(spark, folder)
    other = F.when(F.col("row_index") % 7 == 0, F.concat(F.lit("n/a "), TS)).otherwise(F.col(TS))
    return cleaning.parse_time(raw.withColumn(TS, other)).select("row_index", SYMBOL, TS)


@query
def clean_dropna(spark, folder):
    kept = cleaning.drop_incomplete(dirty_bars(spark, folder))
    return rounded(kept, "average")


@query
def sort_by_time(spark, folder):
    ordered = cleaning.sort_by_time(bars_from_events(spark, folder), tiebreak=(SYMBOL, "row_index"))
    return ordered.select(TS, SYMBOL, "row_index", "close", "volume")


@query
def clean(spark, folder):
    raw = raw_bars(spark, folder)
    repeated = raw.unionByName(raw.where(F.col("row_index") % 3 == 0))
    return rounded(cleaning.clean(repeated, tiebreak=(SYMBOL,)), "average")


@query
def filter_time_range(spark, folder):
    bars = bars_from_events(spark, folder)
    return rounded(cleaning.between_times(bars, "2024-01-09", "2024-01-13"), "average")


@query
def filter_flagged(spark, folder):
    """Flagged and unflagged bars, tagged; bars without a flag are in neither."""
    bars = staged(enriched(spark, folder).select("row_index", SYMBOL, TS, Z_FLAG), "enriched")
    return (
        cleaning.flagged(bars, Z_FLAG)
        .unionByName(cleaning.flagged(bars, Z_FLAG, value=False))
        .select("row_index", SYMBOL, TS, Z_FLAG)
    )


@query
def head_n(spark, folder):
    bars = bars_from_events(spark, folder)
    first = cleaning.sort_by_time(bars, tiebreak=(SYMBOL,)).limit(5)
    return rounded(first, "average")


# --- features, windows, detectors -------------------------------------------------


@query
def feat_simple_return(spark, folder):
    out = features.add_simple_return(ticks_from_events(spark, folder), **BY_ROW)
    return rounded(out, "simple_return").select("row_index", SYMBOL, TS, "simple_return")


@query
def feat_price_range(spark, folder):
    out = features.add_price_range(bars_from_events(spark, folder))
    return rounded(out, "price_range").select("row_index", SYMBOL, TS, "price_range")


@query
def feat_candle_body(spark, folder):
    out = features.add_candle_body(bars_from_events(spark, folder))
    return rounded(out, "candle_body").select("row_index", SYMBOL, TS, "candle_body")


@query
def features_query(spark, folder):
    out = features.add_features(clean_bars(spark, folder), **BY_ROW)
    names = ("simple_return", "price_range", "candle_body")
    return rounded(out, *names).select("row_index", SYMBOL, TS, *names)


QUERIES["features"] = QUERIES.pop("features_query")


@query
def rolling_mean(spark, folder):
    ticks = ticks_from_events(spark, folder)
    out = rolling.add_rolling_mean(ticks, "close", WINDOW, **BY_ROW)
    return rounded(out, ROLLED[0]).select("row_index", SYMBOL, TS, ROLLED[0])


@query
def rolling_std(spark, folder):
    ticks = ticks_from_events(spark, folder)
    out = rolling.add_rolling_std(ticks, "close", WINDOW, **BY_ROW)
    return rounded(out, ROLLED[1]).select("row_index", SYMBOL, TS, ROLLED[1])


def rolled_ticks(spark, folder):
    return rolling.add_rolling_stats(ticks_from_events(spark, folder), "close", WINDOW, **BY_ROW)


@query
def rolling_stats(spark, folder):
    return rounded(rolled_ticks(spark, folder), *ROLLED).select("row_index", SYMBOL, TS, *ROLLED)


@query
def rolling_stats_pooled(spark, folder):
    """All symbols as one series, the way a file of one symbol is read."""
    out = rolling.add_rolling_stats(
        ticks_from_events(spark, folder), "close", WINDOW, partition_cols=(), **BY_ROW
    )
    return rounded(out, *ROLLED).select("row_index", SYMBOL, TS, *ROLLED)


@query
def rolling_stats_wide(spark, folder):
    """A frame of 2,000 order lines of a supplier's line number."""
    lines = series_from_lineitem(spark, folder).withColumn(SYMBOL, F.col("l_linenumber").cast("string"))
    out = rolling.add_rolling_stats(lines, "close", 2000, tiebreak=LINE_ORDER)
    names = ("close_rolling_mean_2000", "close_rolling_std_2000")
    return rounded(out, *names).select(SYMBOL, TS, *LINE_ORDER, *names)


@query
def zscore(spark, folder):
    out = add_rolling_zscore(rolled_ticks(spark, folder), "close", WINDOW)
    return rounded(out, Z).select("row_index", SYMBOL, TS, Z)


@query
def zscore_flag(spark, folder):
    scored = add_rolling_zscore(rolled_ticks(spark, folder), "close", WINDOW)
    out = add_zscore_anomaly_flag(scored, "close", WINDOW)
    return out.select("row_index", SYMBOL, TS, Z_FLAG)


@query
def detect_zscore(spark, folder):
    rolled = rolling.add_rolling_stats(bars_from_events(spark, folder), "close", WINDOW, **BY_ROW)
    out = detect_zscore_anomalies(rolled, "close", WINDOW)
    return rounded(out, Z).select("row_index", SYMBOL, TS, "close", Z, Z_FLAG)


@query
def iqr_bounds(spark, folder):
    ticks = ticks_from_events(spark, folder)
    return rounded(iqr.iqr_bounds(ticks, "close", relative_error=0), "lower", "upper")


@query
def iqr_bounds_approx(spark, folder):
    """The default fences come from a sketch: are its quartiles as close as promised?"""
    ticks = ticks_from_events(spark, folder)
    found = iqr.quartiles(ticks, "close", RELATIVE_ERROR)
    edges = ticks.withColumn("_q", found.select(F.struct("q1", "q3")).scalar())
    close = F.col("close")

    def holds(prob: float, edge: str):
        below, upto = (F.count_if(c) / F.count(close) for c in (close < F.col(edge), close <= F.col(edge)))
        return (below <= prob + RELATIVE_ERROR) & (upto >= prob - RELATIVE_ERROR)

    return edges.agg(holds(0.25, "_q.q1").alias("q1_holds"), holds(0.75, "_q.q3").alias("q3_holds"))


@query
def iqr_flag(spark, folder):
    """Fences given as numbers."""
    out = iqr.add_iqr_anomaly_flag(ticks_from_events(spark, folder), "close", 2.5, 150.0)
    return out.select("row_index", SYMBOL, TS, "close", IQR_FLAG)


@query
def detect_iqr(spark, folder):
    ticks = ticks_from_events(spark, folder)
    out = iqr.detect_iqr_anomalies(ticks, "close", relative_error=0)
    return out.select("row_index", SYMBOL, TS, "close", IQR_FLAG)


@query
def detect_iqr_by_symbol(spark, folder):
    ticks = ticks_from_events(spark, folder)
    out = iqr.detect_iqr_anomalies_by(ticks, "close", [SYMBOL], relative_error=0)
    return out.select("row_index", SYMBOL, TS, "close", IQR_FLAG)


# --- per-day analytics ------------------------------------------------------------


@query
def avg_daily_return(spark, folder):
    return rounded(daily.average_daily_return(enriched(spark, folder)), "avg_return")


@query
def top_volatility_symbols(spark, folder):
    top = daily.highest_volatility_symbols(enriched(spark, folder), limit=3)
    return rounded(top, "return_volatility")


@query
def top_anomaly_days(spark, folder):
    return daily.top_anomaly_days(enriched(spark, folder), IQR_FLAG, limit=10)


@query
def daily_volume(spark, folder):
    return daily.daily_trading_volume(bars_from_events(spark, folder))


@query
def rolling_anomaly_counts(spark, folder):
    return daily.rolling_anomaly_counts(enriched(spark, folder), IQR_FLAG)


@query
def daily_mean_series(spark, folder):
    return rounded(daily.daily_series(bars_from_events(spark, folder), "close"), "close")


@query
def price_trend(spark, folder):
    return rounded(daily.price_trend(enriched(spark, folder)), "value")


@query
def daily_zscore(spark, folder):
    return rounded(daily.daily_series(enriched(spark, folder), Z), Z)


@query
def daily_rolling_stats(spark, folder):
    return rounded(daily.daily_means(enriched(spark, folder), ROLLED), *ROLLED)


@query
def daily_anomaly_counts(spark, folder):
    return daily.daily_anomaly_counts(enriched(spark, folder))


@query
def monthly_anomaly_counts(spark, folder):
    return daily.monthly_anomaly_counts(enriched(spark, folder))


@query
def top_days_combined(spark, folder):
    return daily.top_days_combined(enriched(spark, folder))


# --- a kept rollup ----------------------------------------------------------------


def kept_rollup(spark, folder, rows=None):
    """The days of January's first half are there already; the others arrive, one of them twice."""
    lake, rolled = new_folder(spark, "lake"), rollup.Rollup(new_folder(spark, "rollup"), **BY_ROW)
    bars = enriched(spark, folder) if rows is None else rows
    layout.load_table(bars, lake, "overwrite")
    day = F.col(DAY)
    days = [r[DAY] for r in read_enriched(lake, spark).select(DAY).distinct().orderBy(DAY).collect()]
    rolled.add(read_enriched(lake, spark).where(day < days[len(days) // 2]))
    rolled.refresh(spark, lake, days[len(days) // 2 :])
    rolled.refresh(spark, lake, days[-1:])
    return rolled.read(spark)


@query
def rollup_summary(spark, folder):
    kept = kept_rollup(spark, folder)
    mean = rollup.daily_average(kept, "simple_return").withColumnRenamed("mean", "avg_return")
    return rounded(rollup.daily_summary(kept).join(mean, [DAY, SYMBOL], "left"), "avg_return")


@query
def rollup_volatility(spark, folder):
    top = rollup.highest_volatility_symbols(kept_rollup(spark, folder), limit=3)
    return rounded(top, "return_volatility")


@query
def rollup_anomaly_counts(spark, folder):
    return rollup.rolling_anomaly_counts(kept_rollup(spark, folder))


@query
def rollup_daily_series(spark, folder):
    return rounded(rollup.daily_series(kept_rollup(spark, folder), "close"), "close")


@query
def iqr_bounds_merged(spark, folder):
    """Fences from sketches of single days, with the exact edges that their ranks must lie between."""
    ticks = ticks_from_events(spark, folder).withColumns(
        {"simple_return": F.lit(None).cast("double"), Z_FLAG: F.lit(None).cast("boolean"), IQR_FLAG: F.lit(None).cast("boolean")}
    )
    bounds = rollup.iqr_bounds_merged(kept_rollup(spark, folder, ticks), by=[SYMBOL])
    probs = [p + e for p in (0.25, 0.75) for e in (-RELATIVE_ERROR, RELATIVE_ERROR)]
    edges = exact_quantiles(ticks, "close", probs, by=[SYMBOL]).select(SYMBOL, "quantiles")
    edge = [F.col("quantiles")[i] for i in range(4)]
    return bounds.join(edges, SYMBOL).select(
        SYMBOL,
        "n",
        *[e.alias(name) for e, name in zip(edge, ("q1_from", "q1_to", "q3_from", "q3_to"))],
        F.col("q1").between(edge[0], edge[1]).alias("q1_holds"),
        F.col("q3").between(edge[2], edge[3]).alias("q3_holds"),
    )


# --- histograms and profiles ------------------------------------------------------


@query
def hist_close_by_iqr(spark, folder):
    out = histograms.histogram_by_flag(enriched(spark, folder))
    return rounded(out, "lower", "upper")


@query
def hist_numeric(spark, folder):
    bars = staged(rounded(clean_bars(spark, folder).select(*RAW_COLUMNS), "average"), "clean")
    return rounded(histograms.histogram_numeric(bars), "lower", "upper")


@query
def hist_log_volume(spark, folder):
    out = histograms.histogram_log(bars_from_events(spark, folder), digits=9)
    return rounded(out, "lower", "upper")


@query
def feature_correlation(spark, folder):
    return rounded(profile.correlation_matrix(enriched(spark, folder)), "corr")


@query
def sample_rows(spark, folder):
    ticks = ticks_from_events(spark, folder)
    return profile.sample_rows(ticks, 200, key=["row_index"]).select("row_index", SYMBOL, TS, "close")


@query
def profile_nulls(spark, folder):
    return profile.null_counts(dirty_bars(spark, folder))


@query
def profile_duplicates(spark, folder):
    return profile.duplicate_count(dirty_bars(spark, folder))


@query
def describe(spark, folder):
    stats = profile.describe(staged(clean_bars(spark, folder), "clean"))
    return rounded(stats, "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def boxplot_stats(spark, folder):
    stats = profile.boxplot_stats(ticks_from_events(spark, folder), "close")
    return rounded(stats, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def time_range(spark, folder):
    return profile.time_range(ticks_from_events(spark, folder))


@query
def return_distribution(spark, folder):
    ticks = intraday.add_log_return(ticks_from_events(spark, folder), **BY_ROW)
    return rounded(
        profile.return_distribution(ticks, "log_return"),
        "mean", "std", "skewness", "excess_kurtosis", "jarque_bera",
    )


# --- quarantine -------------------------------------------------------------------


@query
def ingest_normalise(spark, folder):
    return rounded(q.ingest_normalise(raw_bars(spark, folder)), "average")


@query
def dedupe_by_ts(spark, folder):
    """Events of the same type and minute are one instant here: the first is kept."""
    minute = F.date_trunc("minute", F.col(TS)).cast("timestamp_ntz")
    ticks = ticks_from_events(spark, folder).withColumn(TS, minute)
    return q.dedupe_by_ts(ticks).select("row_index", SYMBOL, TS, "close", "volume")


def judged(spark, folder):
    return q.add_reason(q.dedupe_by_ts(dirty_bars(spark, folder)))


@query
def quarantine(spark, folder):
    return judged(spark, folder).select(
        "row_index", SYMBOL, TS, "open", "high", "low", "close", "volume", "reason"
    )


@query
def quarantine_metrics(spark, folder):
    return q.quarantine_metrics(judged(spark, folder), dirty_bars(spark, folder))


@query
def sink_quarantine(spark, folder):
    path = new_folder(spark, "quarantine")
    layout.write_quarantine(q.quarantined(judged(spark, folder)), path)
    return read_enriched(path, spark).select(
        DAY, "row_index", SYMBOL, TS, "open", "high", "low", "close", "volume", "reason"
    )


@query
def pipeline_intraday(spark, folder):
    """From CSV files with planted faults to the bars and the quarantine, read back together."""
    incoming, root = new_folder(spark, "incoming"), new_folder(spark, "intraday")
    as_raw(dirty_bars(spark, folder)).write.option("header", True).csv(incoming)
    tables = run_intraday(spark, incoming, root, run_id="one")
    columns = (DAY, "row_index", SYMBOL, TS, "close", "volume")
    anomalies = rounded(read_enriched(tables.anomalies, spark), "anomaly_score")
    bars = read_enriched(tables.bars, spark).select(*columns)
    labels = anomalies.select("row_index", "anomaly_label", "anomaly_score", "run_id")
    good = bars.join(labels, "row_index").select(*columns, "anomaly_label", "anomaly_score", "run_id")
    bad = read_enriched(tables.quarantine, spark)
    return good.unionByName(
        bad.select(
            *columns, F.col("reason").alias("anomaly_label"), F.lit(None).cast("double").alias("anomaly_score"), "run_id"
        )
    )


@query
def pipeline_intraday_metrics(spark, folder):
    incoming, root = new_folder(spark, "incoming"), new_folder(spark, "intraday")
    as_raw(dirty_bars(spark, folder)).write.option("header", True).csv(incoming)
    tables = run_intraday(spark, incoming, root, run_id="one")
    return spark.read.json(tables.metrics).select("reason", "rows_quarantined", "rows_in", "collisions", "rows_out")


# --- inside the day ---------------------------------------------------------------

KEY = ("row_index", SYMBOL, TS)


@query
def log_return(spark, folder):
    out = intraday.add_log_return(ticks_from_events(spark, folder), **BY_ROW)
    names = ("log_return", "simple_return")
    return rounded(out, *names).select(*KEY, *names)


@query
def rolling_return_stats(spark, folder):
    out = intraday.add_rolling_return_stats(ticks_from_events(spark, folder), **BY_ROW)
    names = ("rolling_mean_return_20", "rolling_std_return_20")
    return rounded(out, *names).select(*KEY, *names)


@query
def realized_vol(spark, folder):
    out = intraday.add_realized_vol(ticks_from_events(spark, folder), **BY_ROW)
    return rounded(out, "realized_vol_60").select(*KEY, "realized_vol_60")


@query
def rolling_volume_stats(spark, folder):
    out = intraday.add_rolling_volume_stats(ticks_from_events(spark, folder), **BY_ROW)
    names = ("volume_rolling_mean_20", "volume_rolling_std_20")
    return rounded(out, *names).select(*KEY, *names)


@query
def session_features(spark, folder):
    out = intraday.add_session_features(ticks_from_events(spark, folder))
    return out.select(*KEY, "session_minute", "is_session_open", "is_session_close")


@query
def volume_zscore(spark, folder):
    rolled = intraday.add_rolling_volume_stats(ticks_from_events(spark, folder), **BY_ROW)
    out = add_volume_zscore(rolled)
    return rounded(out, "volume_zscore").select(*KEY, "volume_zscore", "is_volume_anomaly")


@query
def vol_regime(spark, folder):
    out = intraday.add_vol_regime(ticks_from_events(spark, folder), **BY_ROW)
    return out.select(*KEY, "is_volatility_regime")


@query
def ewma_vol(spark, folder):
    out = intraday.add_ewma_vol(ticks_from_events(spark, folder), **BY_ROW)
    return rounded(out, "ewma_vol_20").select(*KEY, "ewma_vol_20")


@query
def rolling_return(spark, folder):
    out = features.add_rolling_return(ticks_from_events(spark, folder), **BY_ROW)
    return rounded(out, "close_return_20").select(*KEY, "close_return_20")


@query
def anomaly_rules(spark, folder):
    out = label_intraday(ticks_from_events(spark, folder), **BY_ROW)
    return rounded(out, "return_zscore", "volume_zscore", "anomaly_score").select(
        *KEY, "return_zscore", "volume_zscore", "is_return_anomaly", "is_volume_anomaly",
        "is_volatility_regime", "anomaly_label", "anomaly_score",
    )


@query
def intraday_returns(spark, folder):
    ticks = ticks_from_events(spark, folder)
    bars = intraday.add_log_return(ticks, **BY_ROW).select(*KEY, "close", "log_return")
    flags = labelled(spark, folder).select(*KEY, "close", "anomaly_label", "anomaly_score")
    # Both tables in buckets of the key, so that they meet without a shuffle.
    bars, flags = (
        layout.write_bucketed(t, new_folder(spark, "bucketed"), KEY, 8) for t in (bars, flags)
    )
    out = views.intraday_returns(bars, flags, key=KEY)
    return rounded(out, "log_return", "anomaly_score")


@query
def daily_summary(spark, folder):
    out = views.daily_summary(labelled(spark, folder), tiebreak=("row_index",))
    return rounded(out, "avg_realized_vol")


@query
def anomalies_ranked(spark, folder):
    out = views.anomalies_ranked(labelled(spark, folder), top=5, tiebreak=("row_index",))
    return rounded(out, "anomaly_score").select(
        DAY, "rank", *KEY, "anomaly_label", "anomaly_score"
    )


@query
def anomaly_calendar(spark, folder):
    return views.anomaly_calendar(labelled(spark, folder))


@query
def label_by_month(spark, folder):
    return views.label_by_month(labelled(spark, folder))


@query
def run_compare(spark, folder):
    """Two runs of the rule engine, the second with lower thresholds."""
    ticks = intraday.add_intraday_features(ticks_from_events(spark, folder), **BY_ROW)
    ticks = staged(ticks, "intraday")
    strict = apply_rules(ticks, Rules(), run_id="strict")
    loose = apply_rules(ticks, Rules(return_threshold=2.0, volume_threshold=2.0), run_id="loose")
    out = views.run_compare(strict.unionByName(loose))
    return rounded(out, "mean_score", "std_score", "max_score")


# --- streams ----------------------------------------------------------------------


@query
def stream_ingest(spark, folder):
    """Raw bars arrive in two batches of files; the second run goes on from the first.

    Every fifth bar comes twice in its batch, and every third of the first once more in the second.
    """
    incoming, lake = new_folder(spark, "incoming"), new_folder(spark, "lake")
    checkpoint = new_folder(spark, "checkpoint")
    bars = bars_from_events(spark, folder)
    early = F.col(TS) < F.lit("2024-01-16").cast("timestamp_ntz")
    again = bars.where(early & (F.col("row_index") % 3 == 0))
    twice = bars.where(F.col("row_index") % 5 == 0)
    for part in (
        bars.where(early).unionByName(twice.where(early)),
        bars.where(~early).unionByName(twice.where(~early)).unionByName(again),
    ):
        as_raw(part).write.mode("append").option("header", True).csv(incoming)
        arriving = clean_stream(stream_raw_csv(spark, incoming))
        ingest_available(arriving, lake, checkpoint).awaitTermination()
    return rounded(read_enriched(lake, spark).drop(DAY), "average")


@query
def stream_zscore(spark, folder):
    """Events arrive in three batches; scores carry on across them and across restarts.

    One symbol is two days behind the others throughout. Half of the events of three hours come a batch
    early, which the delay bears; some events have lost their time, and are set aside.
    """
    incoming, checkpoint = new_folder(spark, "incoming"), new_folder(spark, "checkpoint")
    scores = ZScoreStream(output=new_folder(spark, "scores"), delay="6 hours", **BY_ROW)
    ticks = ticks_from_events(spark, folder).select(*KEY, "close")
    behind = F.when(F.col(SYMBOL) == "click", F.expr("interval 2 days")).otherwise(F.expr("interval 0 days"))
    at, odd = F.col(TS) + behind, F.col("row_index") % 2 == 1
    first, soon, second = (
        F.lit(d).cast("timestamp_ntz") for d in ("2024-01-11", "2024-01-11 03:00:00", "2024-01-21")
    )
    early = (at < first) | ((at < soon) & odd)
    lost = ticks.where("row_index % 97 = 0").withColumn(TS, F.lit(None).cast("timestamp_ntz"))
    for part in (
        ticks.where(early),
        ticks.where(~early & (at < second)).unionByName(lost),
        ticks.where(at >= second),
    ):
        part.write.mode("append").parquet(incoming)
        arriving = spark.readStream.schema(ticks.schema).parquet(incoming)
        scores.start(arriving, checkpoint).awaitTermination()
    scores.finish(spark, checkpoint)
    aside = scores.read_rejects(spark).select(
        *KEY, F.lit(None).cast("double").alias(Z), F.lit(None).cast("boolean").alias(Z_FLAG)
    )
    return rounded(scores.read(spark), Z).select(*KEY, Z, Z_FLAG).unionByName(aside)
