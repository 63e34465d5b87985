"""The whole chain from raw bars to the enriched table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstats.operators.blocks import over_series
from barstats.operators.checks import (
    validate_not_empty,
    validate_numeric_columns,
    validate_required_columns,
    validate_schema,
)
from barstats.operators.clean import clean, parse_time
from barstats.operators.features import candle_body, price_range, simple_return_stage
from barstats.operators.intraday import add_intraday_features
from barstats.operators.iqr import detect_iqr_anomalies
from barstats.operators.quarantine import (
    add_reason,
    dedupe_by_ts,
    good_bars,
    quarantine_metrics,
    quarantined,
)
from barstats.operators.rolling import rolling_stage
from barstats.operators.rules import Rules, apply_rules
from barstats.operators.zscore import detect_zscore_anomalies
from barstats.schema import (
    IQR_K,
    KEYED_SCHEMA,
    RAW_SCHEMA,
    RELATIVE_ERROR,
    ROW_ID,
    SYMBOL,
    TS,
    WINDOW,
    Z_THRESHOLD,
)
from barstats.sources.bars import read_ohlcv_csv
from barstats.sources.layout import DAY, load_table, write_parquet, write_quarantine
from barstats.sources.scratch import staged


@dataclass(frozen=True)
class Settings:
    column: str = "close"
    window: int = WINDOW
    threshold: float = Z_THRESHOLD
    k: float = IQR_K
    relative_error: float = RELATIVE_ERROR


def enrich(
    bars: DataFrame,
    settings: Settings = Settings(),
    *,
    partition_cols: Sequence[str] = (SYMBOL,),
    tiebreak: Sequence[str] = (),
    **blocks,
) -> DataFrame:
    """Features, rolling statistics and both detectors on clean bars.

    The return and the rolling statistics share one shuffle and one sort. The IQR
    fences read a single column of the clean bars, not the windowed table.
    """
    windowed = over_series(
        bars,
        settings.window - 1,
        simple_return_stage,
        rolling_stage(settings.column, settings.window),
        partition_cols=partition_cols,
        tiebreak=tiebreak,
        **blocks,
    ).withColumns({"price_range": price_range(), "candle_body": candle_body()})
    scored = detect_zscore_anomalies(
        windowed, settings.column, settings.window, settings.threshold
    )
    return detect_iqr_anomalies(
        scored, settings.column, settings.k, settings.relative_error, source=bars
    )


def flagship(
    raw: DataFrame, settings: Settings = Settings(), *, stage: bool = True, **series
) -> DataFrame:
    """Clean raw bars that carry a symbol, and enrich them.

    Cleaning ends in a shuffle of whole rows, and enriching reads the clean bars
    several times, a column or three at a time. So they are written out in between,
    unless ``stage`` is off.
    """
    bars = clean(raw, sort=False)
    return enrich(staged(bars, "clean") if stage else bars, settings, **series)


def label_intraday(
    bars: DataFrame, rules: Rules = Rules(), run_id: str | None = None, **series
) -> DataFrame:
    """Day-scoped features and the rule engine on clean bars."""
    return apply_rules(add_intraday_features(bars, rules.size, **series), rules, run_id)


def run_pipeline(
    spark: SparkSession,
    source: str,
    lake: str,
    table: str | None = None,
    *,
    symbol: str | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """A CSV file or folder of bars to the enriched Parquet table, or to a table by day.

    The bars are of one ``symbol``, or carry theirs in a last column. They are written once:
    by day if ``table`` is given, else as they come to ``lake``. Returns the written table, read back.
    """
    raw = read_ohlcv_csv(source, spark, schema=KEYED_SCHEMA if symbol is None else RAW_SCHEMA)
    validate_schema(raw, KEYED_SCHEMA if symbol is None else RAW_SCHEMA)
    validate_required_columns(raw)
    validate_not_empty(raw)
    validate_numeric_columns(raw)
    tagged = raw if symbol is None else raw.withColumn(SYMBOL, F.lit(symbol))
    enriched = flagship(tagged, settings, tiebreak=("row_index",))
    if table is None:
        write_parquet(enriched, lake)
        return spark.read.parquet(lake)
    load_table(enriched, table, mode="overwrite")
    return spark.read.parquet(table).drop(DAY)


@dataclass(frozen=True)
class IntradayTables:
    """Where a run of :func:`run_intraday` wrote its tables."""

    root: str

    @property
    def bars(self) -> str:
        return f"{self.root}/processed_bars"

    @property
    def anomalies(self) -> str:
        return f"{self.root}/anomalies"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"


ANOMALY_COLUMNS = (
    ROW_ID,
    SYMBOL,
    TS,
    "close",
    "log_return",
    "return_zscore",
    "volume_zscore",
    "is_return_anomaly",
    "is_volume_anomaly",
    "is_volatility_regime",
    "anomaly_label",
    "anomaly_score",
    "run_id",
)


def run_intraday(
    spark: SparkSession, source: str, root: str, *, run_id: str, rules: Rules = Rules()
) -> IntradayTables:
    """A folder of keyed CSV files to bars, anomalies, quarantine and metrics.

    Bars of an instant that was seen before are dropped and counted, bars that break a rule go to
    the quarantine by day and reason; the others get day-scoped features and labels. Bars and
    anomalies carry the run's id and replace the days they have, so a day can be run again.
    Two tables are written out on the way, for all that follows reads them: the judged
    bars and the labelled ones.
    """
    out = IntradayTables(root.rstrip("/"))
    raw = parse_time(read_ohlcv_csv(source, spark, schema=KEYED_SCHEMA))
    judged = staged(add_reason(dedupe_by_ts(raw)), "judged")
    write_quarantine(quarantined(judged).withColumn("run_id", F.lit(run_id)), out.quarantine, "overwrite")
    metrics = quarantine_metrics(judged, raw).withColumn("run_id", F.lit(run_id))
    metrics.coalesce(1).write.mode("overwrite").json(out.metrics)
    labelled = staged(label_intraday(good_bars(judged), rules, run_id, tiebreak=(ROW_ID,)), "labelled")
    day = {"mode": "overwrite", "only_days_written": True}
    load_table(labelled, out.bars, **day)
    load_table(labelled.select(*ANOMALY_COLUMNS), out.anomalies, clustering_fields=("anomaly_label",), **day)
    return out
