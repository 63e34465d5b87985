"""The catalogue's results as DuckDB SQL, written independently of the operators."""

from __future__ import annotations

from itertools import combinations

from barstats.schema import CORRELATION_FEATURES, KEYED_SCHEMA, NUMERIC_COLUMNS

ORACLE: dict[str, str] = {}


def r(expression: str, name: str | None = None) -> str:
    return f"round(({expression}) + 1e-9, 6) + 0.0 AS {name or expression}"


def rs(*names: str) -> str:
    return ", ".join(r(n) for n in names)


_CTES = {
    "ev": """SELECT event_id, ts, event_type, value,
        CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events""",
    "bars": """SELECT min(event_id) AS row_index, date_trunc('hour', ts) AS date,
        arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
        arg_max(value, (ts, event_id)) AS close, CAST(sum(k) AS BIGINT) AS volume, count(*) AS barCount,
        sum(value * k) / nullif(CAST(sum(k) AS DOUBLE), 0) AS average, event_type AS symbol
        FROM ev GROUP BY event_type, date_trunc('hour', ts)""",
    "good": "SELECT * FROM bars WHERE average IS NOT NULL",
    "ticks": """SELECT event_id AS row_index, ts AS date, value AS open, value AS high,
        value AS low, value AS close, k AS volume, CAST(1 AS BIGINT) AS barCount,
        value AS average, event_type AS symbol FROM ev""",
    "dirty1": """SELECT row_index, CASE WHEN row_index % 47 <> 0 THEN date END AS date, open,
        CASE WHEN row_index % 51 = 0 THEN low - 1 ELSE high END AS high, low,
        CASE WHEN row_index % 50 <> 0 THEN close END AS close,
        CASE WHEN row_index % 53 = 0 THEN -1 - volume ELSE volume END AS volume,
        barCount, average, symbol FROM bars""",
    "dirty": "SELECT * FROM dirty1 UNION ALL SELECT * FROM dirty1 WHERE row_index % 40 = 0",
}

_USES = {
    "ev": (), "bars": ("ev",), "good": ("bars",), "ticks": ("ev",),
    "dirty1": ("bars",), "dirty": ("dirty1",),
}


def _rolled(source: str, order: str = "date, row_index", keys: str = "PARTITION BY symbol") -> str:
    """Returns, rolling statistics, scores and z flags over a source with a close."""
    return f"""SELECT *, close_zscore_20 IS NOT NULL AND abs(close_zscore_20) > 3.0 AS _z,
        abs(close_zscore_20) > 3.0 AS close_zscore_anomaly_20
      FROM (SELECT *, (close - close_rolling_mean_20)
          / CASE WHEN round(close_rolling_std_20, 9) = 0 THEN NULL ELSE close_rolling_std_20 END
          AS close_zscore_20
        FROM (SELECT *, (close - lag(close) OVER s) / nullif(lag(close) OVER s, 0) AS simple_return,
            avg(close) OVER w AS close_rolling_mean_20,
            stddev_samp(close) OVER w AS close_rolling_std_20
          FROM {source}
          WINDOW s AS ({keys} ORDER BY {order}),
            w AS ({keys} ORDER BY {order} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)))"""


def _fences(source: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    head = f"{by}, " if by else ""
    return f"""SELECT {head} q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
      FROM (SELECT {head} quantile_disc(close, 0.25) AS q1, quantile_disc(close, 0.75) AS q3
        FROM {source} {group})"""


_CTES["rolled_ticks"] = _rolled("ticks")
_CTES["pooled_ticks"] = _rolled("ticks", keys="")
_CTES["rolled_bars"] = _rolled("bars")
_CTES["rolled_good"] = _rolled("good")
_CTES["fences"] = _fences("good")
_CTES["tick_fences"] = _fences("ticks")
_CTES["symbol_fences"] = _fences("ticks", "symbol")
_CTES["enriched"] = """SELECT *, high - low AS price_range, close - open AS candle_body,
    close < lower OR close > upper AS close_iqr_anomaly FROM rolled_good, fences"""

_CTES["day1"] = """SELECT *, CAST(date AS DATE) AS trading_day,
    close / nullif(lag(close) OVER (PARTITION BY symbol, CAST(date AS DATE)
      ORDER BY date, row_index), 0) AS chg FROM ticks"""
_CTES["day2"] = """SELECT *, CASE WHEN chg > 0 THEN ln(CASE WHEN chg > 0 THEN chg END) END
    AS log_return, chg - 1 AS simple_return FROM day1"""
_CTES["day3"] = """SELECT *, avg(log_return) OVER w AS rolling_mean_return_20,
    stddev_samp(log_return) OVER w AS rolling_std_return_20,
    sqrt(sum(log_return * log_return) OVER v) AS realized_vol_60,
    avg(volume) OVER w AS volume_rolling_mean_20,
    stddev_samp(volume) OVER w AS volume_rolling_std_20
  FROM day2
  WINDOW w AS (PARTITION BY symbol, trading_day ORDER BY date, row_index
      ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    v AS (PARTITION BY symbol, trading_day ORDER BY date, row_index
      ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"""
_CTES["day4"] = """SELECT *, realized_vol_60 > quantile_cont(realized_vol_60, 0.95) OVER (
      PARTITION BY symbol, trading_day ORDER BY date, row_index
      ROWS BETWEEN 389 PRECEDING AND CURRENT ROW) AS is_volatility_regime,
    (log_return - rolling_mean_return_20)
      / CASE WHEN round(rolling_std_return_20, 9) = 0 THEN NULL ELSE rolling_std_return_20 END
      AS return_zscore,
    (volume - volume_rolling_mean_20)
      / CASE WHEN round(volume_rolling_std_20, 9) = 0 THEN NULL ELSE volume_rolling_std_20 END
      AS volume_zscore FROM day3"""


def _labelled(return_threshold: float = 3.0, volume_threshold: float = 3.0) -> str:
    return f"""SELECT *, CASE
        WHEN CAST(coalesce(is_return_anomaly, false) AS INT)
          + CAST(coalesce(is_volume_anomaly, false) AS INT)
          + CAST(coalesce(is_volatility_regime, false) AS INT) >= 2 THEN 'composite'
        WHEN is_return_anomaly THEN 'return' WHEN is_volume_anomaly THEN 'volume'
        WHEN is_volatility_regime THEN 'volatility' ELSE 'none' END AS anomaly_label,
      coalesce(abs(return_zscore), 0.0) + coalesce(abs(volume_zscore), 0.0) AS anomaly_score
      FROM (SELECT *, abs(return_zscore) > {return_threshold} AS is_return_anomaly,
        volume_zscore > {volume_threshold} AS is_volume_anomaly FROM day4)"""


_CTES["labelled"] = _labelled()
_CTES["labelled_loose"] = _labelled(2.0, 2.0)
_CTES["judged"] = """SELECT row_index, symbol, date, open, high, low, close, volume, CASE
      WHEN date IS NULL THEN 'bad_timestamp' WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL
        THEN 'null_ohlcv'
      WHEN NOT (high >= open AND high >= close AND low <= open AND low <= close AND high >= low
        AND open > 0 AND high > 0 AND low > 0 AND close > 0) THEN 'ohlc_invariant'
      WHEN volume < 0 OR barCount < 0 THEN 'negative_count'
      WHEN NOT (hour(date) * 60 + minute(date) BETWEEN 570 AND 959) THEN 'extended_hours'
    END AS reason
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY row_index) AS nth FROM dirty)
  WHERE nth = 1 OR date IS NULL"""

_USES.update({
    "rolled_ticks": ("ticks",), "pooled_ticks": ("ticks",), "rolled_bars": ("bars",),
    "rolled_good": ("good",), "fences": ("good",), "tick_fences": ("ticks",),
    "symbol_fences": ("ticks",), "enriched": ("rolled_good", "fences"), "day1": ("ticks",),
    "day2": ("day1",), "day3": ("day2",), "day4": ("day3",), "labelled": ("day4",),
    "labelled_loose": ("day4",), "judged": ("dirty",),
})


def _needed(name: str, seen: list[str]) -> None:
    for use in _USES.get(name, ()):
        _needed(use, seen)
    if name in _CTES and name not in seen:
        seen.append(name)


def oracle(name: str, body: str, *uses: str) -> None:
    seen: list[str] = []
    for use in uses:
        _needed(use, seen)
    head = ", ".join(f"{n} AS MATERIALIZED ({_CTES[n]})" for n in seen)
    ORACLE[name] = (f"WITH {head} " if head else "") + body


BAR = f"row_index, date, open, high, low, close, volume, barCount, {r('average')}, symbol"
BAR_TEXT = BAR.replace("date,", "strftime(date, '%Y%m%d  %H:%M:%S') AS date,", 1)
KEY = "row_index, symbol, date"
ROLLED = ("close_rolling_mean_20", "close_rolling_std_20")
MEASURES = ("simple_return", "price_range", "candle_body", *ROLLED, "close_zscore_20")
FLAGS = "close_zscore_anomaly_20, close_iqr_anomaly"
ENRICHED = f"""SELECT row_index, date, open, high, low, close, volume, barCount,
    {rs('average', *MEASURES)}, {FLAGS}, symbol FROM enriched"""
DAY = "CAST(date AS DATE) AS trading_day"

oracle("flagship", ENRICHED, "enriched")
oracle("scan_parquet", ENRICHED, "enriched")

_LINES = """(SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS date, l_orderkey,
    l_linenumber, l_partkey, l_extendedprice, l_extendedprice AS close FROM lineitem)"""
_LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_extendedprice"
ORACLE["flagship_series"] = f"""WITH lines AS MATERIALIZED {_LINES},
    rolled AS ({_rolled('lines', 'date, ' + _LINE_ORDER)}), fences AS ({_fences('lines')})
    SELECT symbol, date, {_LINE_ORDER}, close,
      {rs('simple_return', *ROLLED, 'close_zscore_20')}, close_zscore_anomaly_20,
      close < lower OR close > upper AS close_iqr_anomaly FROM rolled, fences"""

ORACLE["rolling_stats_wide"] = f"""SELECT symbol, date, {_LINE_ORDER},
    {r('avg(close) OVER w', 'close_rolling_mean_2000')}, {r('stddev_samp(close) OVER w', 'close_rolling_std_2000')}
    FROM (SELECT * REPLACE (CAST(l_linenumber AS VARCHAR) AS symbol) FROM {_LINES})
    WINDOW w AS (PARTITION BY symbol ORDER BY date, {_LINE_ORDER} ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW)"""

# Sources and sinks.
oracle("scan_csv_bars", f"SELECT {BAR_TEXT} FROM bars", "bars")
oracle("sink_parquet_roundtrip", f"SELECT {BAR} FROM bars", "bars")
oracle("sink_partitioned", f"SELECT {BAR}, {DAY} FROM bars", "bars")
oracle(
    "sink_append",
    f"SELECT {BAR}, {DAY} FROM (SELECT * FROM bars UNION ALL SELECT * FROM bars)",
    "bars",
)
oracle(
    "sink_partition_overwrite",
    f"""SELECT {BAR}, {DAY} FROM (SELECT * REPLACE (
      CASE WHEN date >= '2024-01-16' THEN volume + 1 ELSE volume END AS volume) FROM bars)""",
    "bars",
)
oracle(
    "sink_upsert",
    f"""SELECT {BAR}, {DAY} FROM (SELECT * REPLACE (CASE WHEN row_index % 3 = 0 OR row_index % 4 = 0
      THEN volume + 1 ELSE volume END AS volume) FROM bars)""",
    "bars",
)
for _name in ("retention_filter", "retained_days"):
    oracle(_name, f"SELECT {BAR}, {DAY} FROM bars WHERE CAST(date AS DATE) >= DATE '2024-01-30' - 10", "bars")
oracle(
    "run_summary",
    """SELECT count(*) AS processed_row_count, count(DISTINCT symbol) AS symbols,
      count_if(close_zscore_anomaly_20) AS zscore_anomalies,
      count_if(close_iqr_anomaly) AS iqr_anomalies,
      min(date) AS first_bar, max(date) AS last_bar FROM enriched""",
    "enriched",
)

# Checks and cleaning.
oracle(
    "dq_report",
    f"""SELECT 'schema' AS "check", true AS passed, '{KEYED_SCHEMA.simpleString()}' AS detail
    UNION ALL SELECT 'required_columns', true, ''
    UNION ALL SELECT 'not_empty', count(*) > 0, CAST(count(*) AS VARCHAR) FROM bars
    UNION ALL SELECT 'numeric_columns', true, '' """
    + " ".join(
        f"""UNION ALL SELECT 'missing:{c}', count(*) = count({c}),
        CAST(count(*) - count({c}) AS VARCHAR) FROM bars"""
        for c in KEYED_SCHEMA.names
    ),
    "bars",
)
oracle(
    "dq_report_faults",
    """SELECT 'schema' AS "check", false AS passed, 'struct<row_index:bigint,date:timestamp_ntz,'
      || 'open:double,high:double,low:double,close:string,volume:bigint,barCount:bigint,symbol:string>' AS detail
    UNION ALL SELECT 'required_columns', false, 'average'
    UNION ALL SELECT 'not_empty', count(*) > 0, CAST(count(*) AS VARCHAR) FROM dirty
    UNION ALL SELECT 'numeric_columns', false, 'close' """
    + " ".join(
        f"""UNION ALL SELECT 'missing:{c}', count(*) = count({c}),
        CAST(count(*) - count({c}) AS VARCHAR) FROM dirty"""
        for c in ("row_index", "date", "open", "high", "low", "close", "volume", "barCount", "symbol")
    ),
    "dirty",
)
oracle("profile_shape", "SELECT count(*) AS rows, 10 AS columns FROM bars", "bars")
oracle("clean_dedupe", f"SELECT {BAR_TEXT} FROM bars", "bars")
oracle(
    "clean_parse_ts",
    "SELECT row_index, symbol, CASE WHEN row_index % 7 <> 0 THEN date END AS date FROM bars",
    "bars",
)
oracle(
    "clean_dropna",
    f"""SELECT {BAR} FROM dirty
    WHERE date IS NOT NULL AND close IS NOT NULL AND average IS NOT NULL""",
    "dirty",
)
oracle(
    "sort_by_time",
    "SELECT date, symbol, row_index, close, volume FROM bars ORDER BY date, symbol, row_index",
    "bars",
)
oracle("clean", f"SELECT {BAR} FROM good ORDER BY date, symbol", "good")
oracle(
    "filter_time_range",
    f"SELECT {BAR} FROM bars WHERE date BETWEEN TIMESTAMP '2024-01-09' AND TIMESTAMP '2024-01-13'",
    "bars",
)
oracle(
    "filter_flagged",
    f"""SELECT {KEY}, close_zscore_anomaly_20 FROM rolled_good
    WHERE close_zscore_anomaly_20 IS NOT NULL""",
    "rolled_good",
)
oracle(
    "head_n", f"SELECT {BAR} FROM (SELECT * FROM bars ORDER BY date, symbol LIMIT 5)", "bars"
)

# Features, windows, detectors.
oracle("feat_simple_return", f"SELECT {KEY}, {r('simple_return')} FROM rolled_ticks", "rolled_ticks")
oracle("feat_price_range", f"SELECT {KEY}, {r('high - low', 'price_range')} FROM bars", "bars")
oracle("feat_candle_body", f"SELECT {KEY}, {r('close - open', 'candle_body')} FROM bars", "bars")
oracle("features", f"SELECT {KEY}, {rs(*MEASURES[:3])} FROM enriched", "enriched")
oracle("rolling_mean", f"SELECT {KEY}, {r(ROLLED[0])} FROM rolled_ticks", "rolled_ticks")
oracle("rolling_std", f"SELECT {KEY}, {r(ROLLED[1])} FROM rolled_ticks", "rolled_ticks")
oracle("rolling_stats", f"SELECT {KEY}, {rs(*ROLLED)} FROM rolled_ticks", "rolled_ticks")
oracle("rolling_stats_pooled", f"SELECT {KEY}, {rs(*ROLLED)} FROM pooled_ticks", "pooled_ticks")
_SCORED = f"SELECT {KEY}, {r('close_zscore_20')}"
oracle("zscore", f"{_SCORED} FROM rolled_ticks", "rolled_ticks")
oracle("zscore_flag", f"SELECT {KEY}, close_zscore_anomaly_20 FROM rolled_ticks", "rolled_ticks")
oracle(
    "detect_zscore",
    f"SELECT {KEY}, close, {r('close_zscore_20')}, close_zscore_anomaly_20 FROM rolled_bars",
    "rolled_bars",
)
oracle(
    "stream_zscore",
    f"""{_SCORED}, close_zscore_anomaly_20 FROM rolled_ticks UNION ALL
    SELECT row_index, symbol, NULL, NULL, NULL FROM ticks WHERE row_index % 97 = 0""",
    "rolled_ticks",
)
oracle("stream_ingest", f"SELECT {BAR} FROM good", "good")
oracle("iqr_bounds", f"SELECT {rs('lower', 'upper')} FROM tick_fences", "tick_fences")
oracle(
    "iqr_bounds_approx",
    "SELECT count(*) > 0 AS q1_holds, count(*) > 0 AS q3_holds FROM ticks",
    "ticks",
)
_IQR = f"SELECT {KEY}, close, close < lower OR close > upper AS close_iqr_anomaly FROM ticks"
oracle(
    "iqr_flag",
    f"SELECT {KEY}, close, close < 2.5 OR close > 150.0 AS close_iqr_anomaly FROM ticks",
    "ticks",
)
oracle("detect_iqr", f"{_IQR}, tick_fences", "tick_fences")
oracle("detect_iqr_by_symbol", f"{_IQR} JOIN symbol_fences USING (symbol)", "symbol_fences")

# Per-day analytics.
oracle(
    "avg_daily_return",
    f"""SELECT {DAY}, symbol, {r('avg(simple_return)', 'avg_return')} FROM enriched
    WHERE simple_return IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
    "enriched",
)
oracle(
    "top_volatility_symbols",
    f"""SELECT symbol, {r('stddev_samp(simple_return)', 'return_volatility')},
    count(*) AS observations FROM enriched WHERE simple_return IS NOT NULL
    GROUP BY symbol ORDER BY stddev_samp(simple_return) DESC, symbol LIMIT 3""",
    "enriched",
)
oracle(
    "top_anomaly_days",
    f"""SELECT {DAY}, symbol, count_if(close_iqr_anomaly) AS anomaly_count FROM enriched
    GROUP BY 1, 2 HAVING anomaly_count > 0 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "enriched",
)
oracle(
    "rollup_summary",
    f"""SELECT {DAY}, symbol, count(*) AS bars, arg_min(open, (date, row_index)) AS open, max(high) AS high,
      min(low) AS low, arg_max(close, (date, row_index)) AS close, CAST(sum(volume) AS BIGINT) AS volume,
      count_if(close_zscore_anomaly_20) AS zscore, count_if(close_iqr_anomaly) AS iqr,
      count_if(coalesce(close_zscore_anomaly_20, false) OR coalesce(close_iqr_anomaly, false)) AS either,
      {r('avg(simple_return)', 'avg_return')} FROM enriched GROUP BY 1, 2""",
    "enriched",
)
oracle(
    "rollup_volatility",
    f"""SELECT symbol, {r('stddev_samp(simple_return)', 'return_volatility')},
    count(simple_return) AS observations FROM enriched
    GROUP BY symbol ORDER BY stddev_samp(simple_return) DESC, symbol LIMIT 3""",
    "enriched",
)
oracle(
    "rollup_anomaly_counts",
    """SELECT trading_day, symbol, anomaly_count, CAST(sum(anomaly_count) OVER (PARTITION BY symbol
      ORDER BY trading_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_anomaly_count
    FROM (SELECT CAST(date AS DATE) AS trading_day, symbol, count_if(close_iqr_anomaly) AS anomaly_count
      FROM enriched GROUP BY 1, 2)""",
    "enriched",
)
oracle(
    "rollup_daily_series", f"SELECT {DAY}, {r('avg(close)', 'close')} FROM enriched GROUP BY 1", "enriched"
)
oracle(
    "iqr_bounds_merged",
    """SELECT symbol, count(close) AS n, quantile_disc(close, 0.24) AS q1_from, quantile_disc(close, 0.26) AS q1_to,
      quantile_disc(close, 0.74) AS q3_from, quantile_disc(close, 0.76) AS q3_to,
      true AS q1_holds, true AS q3_holds FROM ticks GROUP BY symbol""",
    "ticks",
)
oracle(
    "daily_volume",
    f"SELECT {DAY}, symbol, CAST(sum(volume) AS BIGINT) AS total_volume FROM bars GROUP BY 1, 2",
    "bars",
)
oracle(
    "rolling_anomaly_counts",
    f"""SELECT *, CAST(sum(anomaly_count) OVER (PARTITION BY symbol ORDER BY trading_day
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_anomaly_count
    FROM (SELECT {DAY}, symbol, count_if(close_iqr_anomaly) AS anomaly_count
      FROM enriched GROUP BY 1, 2)""",
    "enriched",
)
oracle(
    "daily_mean_series",
    f"SELECT {DAY}, {r('avg(close)', 'close')} FROM bars GROUP BY 1 HAVING count(close) > 0",
    "bars",
)
oracle(
    "price_trend",
    f"""SELECT 'daily_mean_close' AS series, date_trunc('day', date)::TIMESTAMP AS at,
      {r('avg(close)', 'value')} FROM enriched GROUP BY 2
    UNION ALL SELECT 'zscore_anomaly', date, {r('close')} FROM enriched
      WHERE close_zscore_anomaly_20
    UNION ALL SELECT 'iqr_anomaly', date, {r('close')} FROM enriched WHERE close_iqr_anomaly""",
    "enriched",
)
oracle(
    "daily_zscore",
    f"""SELECT {DAY}, {r('avg(close_zscore_20)', 'close_zscore_20')} FROM enriched
    GROUP BY 1 HAVING count(close_zscore_20) > 0""",
    "enriched",
)
oracle(
    "daily_rolling_stats",
    f"SELECT {DAY}, {', '.join(r(f'avg({c})', c) for c in ROLLED)} FROM enriched GROUP BY 1",
    "enriched",
)
_COUNTS = """count_if(close_zscore_anomaly_20) AS zscore, count_if(close_iqr_anomaly) AS iqr
    FROM enriched GROUP BY 1"""
oracle("daily_anomaly_counts", f"SELECT {DAY}, {_COUNTS} HAVING zscore + iqr > 0", "enriched")
oracle(
    "monthly_anomaly_counts",
    f"SELECT CAST(date_trunc('month', date) AS DATE) AS month, {_COUNTS}",
    "enriched",
)
oracle(
    "top_days_combined",
    f"""SELECT {DAY}, count_if(coalesce(close_zscore_anomaly_20, false)
      OR coalesce(close_iqr_anomaly, false)) AS anomaly_count
    FROM enriched GROUP BY 1 HAVING anomaly_count > 0 ORDER BY 2 DESC, 1 LIMIT 20""",
    "enriched",
)


# Histograms and profiles.
def _histogram(values: str, bins: int, by: str | None = None) -> str:
    name = by or "_all"
    shown = f"{by}, " if by else ""
    return f"""SELECT {shown} CAST(b AS INTEGER) AS bin, {r('lo + b * w', 'lower')},
        {r('lo + (b + 1) * w', 'upper')}, coalesce(n, 0) AS count
      FROM (SELECT {name}, lo, (hi - lo) / {bins} AS w, unnest(range({bins})) AS b FROM spans)
      LEFT JOIN (SELECT {name}, least(CAST(floor((x - lo) / ((hi - lo) / {bins})) AS BIGINT),
          {bins - 1}) AS b, count(*) AS n FROM ({values}) JOIN spans USING ({name}) GROUP BY 1, 2)
        USING ({name}, b)"""


def _spans(values: str, name: str) -> str:
    return f"""spans AS MATERIALIZED (SELECT {name},
      min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS lo,
      max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS hi FROM ({values}) GROUP BY 1)"""


def histogram_oracle(name: str, values: str, bins: int, by: str | None, uses: str) -> None:
    oracle(name, "", uses)
    ORACLE[name] = (
        f"{ORACLE[name].rstrip()}, {_spans(values, by or '_all')} {_histogram(values, bins, by)}"
    )


histogram_oracle(
    "hist_close_by_iqr",
    "SELECT close_iqr_anomaly, close AS x FROM enriched WHERE close_iqr_anomaly IS NOT NULL",
    80, "close_iqr_anomaly", "enriched",
)
def _melted(columns, source: str, value: str = "x") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS {value} FROM {source}"""
        for c in columns
    )


histogram_oracle(
    "hist_numeric",
    _melted(NUMERIC_COLUMNS, f"(SELECT * REPLACE ({r('average')}) FROM good)"),
    10, '"column"', "good",
)
histogram_oracle(
    "hist_log_volume",
    "SELECT 0 AS _all, round(log10(volume), 9) AS x FROM bars WHERE volume > 0",
    79, None, "bars",
)


def _corr(a: str, b: str) -> str:
    x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return r(f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)", "corr")


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {_corr(a, b)} FROM enriched"
    for a, b in combinations(CORRELATION_FEATURES, 2)
)
_DIAGONAL = " UNION ALL ".join(
    f"SELECT '{c}', '{c}', CASE WHEN stddev_pop({c}) > 0 THEN round(1.0 + 1e-9, 6) END FROM enriched"
    for c in CORRELATION_FEATURES
)
oracle(
    "feature_correlation",
    f""", pairs AS MATERIALIZED ({_PAIRS}) SELECT a, b, corr FROM pairs
    UNION ALL SELECT b, a, corr FROM pairs UNION ALL {_DIAGONAL}""",
    "enriched",
)
ORACLE["feature_correlation"] = ORACLE["feature_correlation"].replace(" , pairs", ", pairs", 1)
oracle(
    "sample_rows",
    f"""SELECT {KEY}, close FROM ticks ORDER BY md5(CAST(row_index AS VARCHAR)), row_index
    LIMIT 200""",
    "ticks",
)
oracle(
    "profile_nulls",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, count(*) AS rows FROM dirty"""
        for c in KEYED_SCHEMA.names
    ),
    "dirty",
)
oracle(
    "profile_duplicates",
    """SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty))
    AS duplicates FROM dirty""",
    "dirty",
)
oracle(
    "describe",
    f"""SELECT "column", count(v) AS count, {r('avg(v)', 'mean')}, {r('stddev_samp(v)', 'std')},
      {r('min(v)', 'min')}, {r('quantile_cont(v, 0.25)', 'p25')},
      {r('quantile_cont(v, 0.5)', 'p50')}, {r('quantile_cont(v, 0.75)', 'p75')},
      {r('max(v)', 'max')} FROM ({_melted(NUMERIC_COLUMNS, 'good', 'v')}) GROUP BY 1""",
    "good",
)
oracle(
    "boxplot_stats",
    f"""SELECT {r('any_value(q1)', 'q1')}, {r('any_value(q2)', 'median')},
      {r('any_value(q3)', 'q3')},
      {r('min(close) FILTER (WHERE close >= q1 - 1.5 * (q3 - q1))', 'whisker_low')},
      {r('max(close) FILTER (WHERE close <= q3 + 1.5 * (q3 - q1))', 'whisker_high')},
      count_if(close < q1 - 1.5 * (q3 - q1) OR close > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM ticks, (SELECT quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.5) AS q2,
      quantile_cont(close, 0.75) AS q3 FROM ticks)""",
    "ticks",
)
oracle("time_range", 'SELECT min(date) AS "first", max(date) AS "last" FROM ticks', "ticks")
oracle(
    "return_distribution",
    f"""SELECT n, {r('m', 'mean')}, {r('sd', 'std')}, {r('s', 'skewness')},
      {r('k', 'excess_kurtosis')}, {r('n / 6 * (s * s + k * k / 4)', 'jarque_bera')}
    FROM (SELECT n, m, sd, m3 / pow(m2, 1.5) AS s, m4 / (m2 * m2) - 3 AS k
      FROM (SELECT count(*) AS n, any_value(mu) AS m, stddev_samp(log_return) AS sd,
          avg(pow(log_return - mu, 2)) AS m2, avg(pow(log_return - mu, 3)) AS m3,
          avg(pow(log_return - mu, 4)) AS m4
        FROM day2, (SELECT avg(log_return) AS mu FROM day2) WHERE log_return IS NOT NULL))""",
    "day2",
)

# Quarantine.
oracle(
    "ingest_normalise",
    f"""SELECT row_index, date AS timestamp, open, high, low, close, volume,
    barCount AS bar_count, {r('average')}, symbol, {DAY} FROM bars""",
    "bars",
)
oracle(
    "dedupe_by_ts",
    """SELECT row_index, symbol, date, close, volume FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY row_index) AS nth
      FROM (SELECT * REPLACE (date_trunc('minute', date) AS date) FROM ticks)) WHERE nth = 1""",
    "ticks",
)
oracle("quarantine", "SELECT * FROM judged", "judged")
oracle(
    "quarantine_metrics",
    """SELECT reason, (SELECT count(*) FROM judged j WHERE j.reason = n.reason)
      AS rows_quarantined, (SELECT count(*) FROM dirty) AS rows_in,
      (SELECT count(*) FROM dirty) - (SELECT count(*) FROM judged) AS collisions,
      (SELECT count(*) FROM judged WHERE reason IS NULL) AS rows_out
    FROM (VALUES ('bad_timestamp'), ('null_ohlcv'), ('ohlc_invariant'), ('negative_count'),
      ('extended_hours')) n(reason)""",
    "judged",
)
oracle(
    "sink_quarantine",
    f"""SELECT {DAY}, row_index, symbol, date, open, high, low, close, volume, reason FROM judged
    WHERE reason IS NOT NULL""",
    "judged",
)

# The same chain over the bars that the quarantine lets through.
_CTES["kept"] = "SELECT * FROM judged WHERE reason IS NULL"
_CTES["kept1"] = _CTES["day1"].replace("FROM ticks", "FROM kept")
_CTES["kept2"] = _CTES["day2"].replace("FROM day1", "FROM kept1")
_CTES["kept3"] = _CTES["day3"].replace("FROM day2", "FROM kept2")
_CTES["kept4"] = _CTES["day4"].replace("FROM day3", "FROM kept3")
_CTES["kept5"] = _labelled().replace("FROM day4", "FROM kept4")
_USES.update({
    "kept": ("judged",), "kept1": ("kept",), "kept2": ("kept1",), "kept3": ("kept2",),
    "kept4": ("kept3",), "kept5": ("kept4",),
})
oracle(
    "pipeline_intraday",
    f"""SELECT trading_day, row_index, symbol, date, close, volume, anomaly_label,
      {r('anomaly_score')}, 'one' AS run_id FROM kept5
    UNION ALL SELECT {DAY}, row_index, symbol, date, close, volume, reason, NULL, 'one'
    FROM judged WHERE reason IS NOT NULL""",
    "kept5",
)
ORACLE["pipeline_intraday_metrics"] = ORACLE["quarantine_metrics"]

# Inside the day.
oracle("log_return", f"SELECT {KEY}, {rs('log_return', 'simple_return')} FROM day2", "day2")
_RETURN_STATS = ("rolling_mean_return_20", "rolling_std_return_20")
_VOLUME_STATS = ("volume_rolling_mean_20", "volume_rolling_std_20")
oracle("rolling_return_stats", f"SELECT {KEY}, {rs(*_RETURN_STATS)} FROM day3", "day3")
oracle("realized_vol", f"SELECT {KEY}, {r('realized_vol_60')} FROM day3", "day3")
oracle("rolling_volume_stats", f"SELECT {KEY}, {rs(*_VOLUME_STATS)} FROM day3", "day3")
oracle(
    "session_features",
    f"""SELECT {KEY}, CAST(m AS INTEGER) AS session_minute, m BETWEEN 0 AND 4 AS is_session_open,
      m BETWEEN 385 AND 389 AS is_session_close
    FROM (SELECT *, hour(date) * 60 + minute(date) - 570 AS m FROM ticks)""",
    "ticks",
)
oracle(
    "volume_zscore",
    f"SELECT {KEY}, {r('volume_zscore')}, is_volume_anomaly FROM labelled",
    "labelled",
)
oracle("vol_regime", f"SELECT {KEY}, is_volatility_regime FROM day4", "day4")
oracle(
    "ewma_vol",
    f"""SELECT {KEY}, {r('''sqrt(list_sum(list_transform(l,
        lambda x, i: x * pow(0.94, len(l) - i)))
      / list_sum(list_transform(l, lambda x, i: pow(0.94, len(l) - i))))''', 'ewma_vol_20')}
    FROM (SELECT *, list(log_return * log_return) FILTER (WHERE log_return IS NOT NULL) OVER (
      PARTITION BY symbol, trading_day ORDER BY date, row_index
      ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS l FROM day2)""",
    "day2",
)
oracle(
    "rolling_return",
    f"""SELECT {KEY}, {r('(close - p) / nullif(p, 0)', 'close_return_20')}
    FROM (SELECT *, lag(close, 20) OVER (PARTITION BY symbol ORDER BY date, row_index) AS p
      FROM ticks)""",
    "ticks",
)
oracle(
    "anomaly_rules",
    f"""SELECT {KEY}, {rs('return_zscore', 'volume_zscore', 'anomaly_score')},
    is_return_anomaly, is_volume_anomaly, is_volatility_regime, anomaly_label FROM labelled""",
    "labelled",
)
oracle(
    "intraday_returns",
    f"""SELECT b.symbol, b.date, b.row_index, b.close, {r('b.log_return', 'log_return')},
      a.anomaly_label, {r('a.anomaly_score', 'anomaly_score')}
    FROM day2 b JOIN labelled a
      ON a.symbol = b.symbol AND a.date = b.date AND a.row_index = b.row_index""",
    "labelled",
)
oracle(
    "daily_summary",
    f"""SELECT symbol, trading_day, arg_min(open, (date, row_index)) AS open, max(high) AS high,
      min(low) AS low, arg_max(close, (date, row_index)) AS close, CAST(sum(volume) AS BIGINT) AS volume,
      {r('avg(realized_vol_60)', 'avg_realized_vol')}, """
    + ", ".join(
        f"count_if(anomaly_label = '{n}') AS {n}_bars"
        for n in ("none", "return", "volume", "volatility", "composite")
    )
    + " FROM labelled GROUP BY symbol, trading_day",
    "labelled",
)
oracle(
    "anomalies_ranked",
    f"""SELECT trading_day, CAST(rank AS INTEGER) AS rank, {KEY}, anomaly_label,
      {r('anomaly_score')}
    FROM (SELECT *, row_number() OVER (PARTITION BY trading_day
        ORDER BY anomaly_score DESC, date, symbol, row_index) AS rank
      FROM labelled WHERE anomaly_label <> 'none') WHERE rank <= 5""",
    "labelled",
)
oracle(
    "anomaly_calendar",
    """SELECT trading_day, anomaly_label, count(*) AS anomaly_count FROM labelled
    WHERE anomaly_label <> 'none' GROUP BY 1, 2""",
    "labelled",
)
oracle(
    "label_by_month",
    """SELECT CAST(date_trunc('month', trading_day) AS DATE) AS month, anomaly_label,
    count(*) AS bars FROM labelled GROUP BY 1, 2""",
    "labelled",
)
oracle(
    "run_compare",
    """SELECT run_id, count(*) AS bars, """
    + ", ".join(
        f"count_if(anomaly_label = '{n}') AS {n}_bars"
        for n in ("return", "volume", "volatility", "composite")
    )
    + f""", {r('avg(anomaly_score)', 'mean_score')}, {r('stddev_samp(anomaly_score)', 'std_score')},
      {r('max(anomaly_score)', 'max_score')}
    FROM (SELECT *, 'strict' AS run_id FROM labelled
      UNION ALL SELECT *, 'loose' FROM labelled_loose) GROUP BY run_id""",
    "labelled", "labelled_loose",
)

# The same results, whatever the blocks.
ORACLE["flagship_blocks"] = ORACLE["flagship"]
ORACLE["rolling_stats_blocks"] = ORACLE["rolling_stats"]
ORACLE["rolling_return_stats_blocks"] = ORACLE["rolling_return_stats"]
