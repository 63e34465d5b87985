from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barstats.operators import quarantine as q
from barstats.operators.clean import parse_time
from barstats.operators.intraday import add_ewma_vol, add_log_return, add_realized_vol, add_session_features
from barstats.operators.rules import Rules, apply_rules
from barstats.operators.views import anomalies_ranked, intraday_returns
from helpers import column, series
from test_clean import GOOD, bar, raw


@pytest.mark.parametrize(
    "changes,reason",
    [
        ({}, None),
        ({"date": "oops", "close": None}, "bad_timestamp"),
        ({"close": None, "high": 1.0}, "null_ohlcv"),
        ({"volume": None}, "null_ohlcv"),
        ({"open": float("nan")}, "null_ohlcv"),
        ({"high": 147.4}, "ohlc_invariant"),
        ({"low": 147.2}, "ohlc_invariant"),
        ({"low": 0.0, "volume": -1}, "ohlc_invariant"),
        ({"volume": -1, "date": "20080103  20:00:00"}, "negative_count"),
        ({"barCount": -1}, "negative_count"),
        ({"date": "20080103  09:29:59"}, "extended_hours"),
        ({"date": "20080103  09:30:00"}, None),
        ({"date": "20080103  15:59:59"}, None),
        ({"date": "20080103  16:00:00"}, "extended_hours"),
        ({"average": None}, None),
    ],
)
def test_first_broken_rule_is_the_reason(spark, changes, reason):
    out = q.add_reason(parse_time(raw(spark, bar(**changes))))
    assert out.first()["reason"] == reason
    assert q.good_bars(out).count() + q.quarantined(out).count() == 1


def test_metrics_add_up(spark):
    rows = [GOOD, bar(close=None), bar(volume=-1), bar(volume=-2)]
    out = q.quarantine_metrics(q.add_reason(parse_time(raw(spark, *rows)))).collect()
    assert {r["reason"]: r["rows_quarantined"] for r in out} == {
        "bad_timestamp": 0, "null_ohlcv": 1, "ohlc_invariant": 0, "negative_count": 2, "extended_hours": 0,
    }
    assert {(r["rows_in"], r["rows_out"]) for r in out} == {(4, 1)}


def test_the_first_bar_of_an_instant_stays(spark):
    bars = raw(spark, bar(row_index=3), bar(row_index=1), bar(row_index=2, date="20080103  09:32:00"))
    kept = q.dedupe_by_ts(bars.withColumn("symbol", F.lit("S")))
    assert column(kept, "row_index", "row_index") == [1, 2]
    plan = q.dedupe_by_ts(bars.withColumn("symbol", F.lit("S")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_bars_without_a_time_are_all_kept_and_counted(spark):
    rows = [bar(row_index=i, date="oops") for i in range(3)] + [bar(row_index=i) for i in (5, 6)]
    bars = parse_time(raw(spark, *rows)).withColumn("symbol", F.lit("S"))
    kept = q.dedupe_by_ts(bars)
    assert column(kept, "row_index", "row_index") == [0, 1, 2, 5]
    out = q.quarantine_metrics(q.add_reason(kept), bars).collect()
    assert {r["reason"]: r["rows_quarantined"] for r in out}["bad_timestamp"] == 3
    assert {(r["rows_in"], r["collisions"], r["rows_out"]) for r in out} == {(5, 1, 1)}


def test_repeated_instants_do_not_multiply_bars(spark):
    times = [datetime(2020, 1, 2, 9, 30)] * 2 + [datetime(2020, 1, 2, 9, 31)]
    bars = spark.createDataFrame(
        [(i, "S", t, float(i), float(-i)) for i, t in enumerate(times)],
        "row_index long, symbol string, date timestamp_ntz, close double, log_return double",
    )
    flags = bars.select("row_index", "symbol", "date", F.lit("none").alias("anomaly_label"))
    assert intraday_returns(bars, flags).count() == 3


def test_normalised_names(spark):
    out = q.ingest_normalise(raw(spark, GOOD))
    assert {"timestamp", "bar_count", "trading_day"} <= set(out.columns)
    assert out.first()["timestamp"] == datetime(2008, 1, 3, 9, 31)


def test_returns_stop_at_midnight(spark):
    bars = series(spark, [10.0, 20.0, 40.0], start=datetime(2020, 1, 2, 23, 58))
    out = add_log_return(bars)
    assert [v is None for v in column(out, "log_return")] == [True, False, True]


def test_zero_prices_have_no_log_return(spark):
    assert column(add_log_return(series(spark, [0.0, 5.0, 0.0, 2.0])), "log_return") == [None] * 4


def test_volatilities(spark):
    bars = series(spark, [1.0, 2.718281828459045, 1.0])
    assert column(add_realized_vol(bars, 5), "realized_vol_5") == [None, pytest.approx(1), pytest.approx(2**0.5)]
    assert column(add_ewma_vol(bars, 5), "ewma_vol_5") == [None, pytest.approx(1), pytest.approx(1)]


def test_session_edges(spark):
    times = ["09:29", "09:30", "09:34", "09:35", "15:54", "15:55", "15:59", "16:00"]
    df = spark.createDataFrame([(datetime.fromisoformat(f"2020-01-02T{t}"),) for t in times], "date timestamp_ntz")
    out = add_session_features(df)
    assert column(out, "is_session_open") == [False, True, True] + [False] * 5
    assert column(out, "is_session_close") == [False] * 5 + [True, True, False]
    assert column(out, "session_minute")[1] == 0


LABELLED = (
    "log_return double, rolling_mean_return_20 double, rolling_std_return_20 double, volume double,"
    " volume_rolling_mean_20 double, volume_rolling_std_20 double, is_volatility_regime boolean"
)


@pytest.mark.parametrize(
    "row,label,score",
    [
        ((0.0, 0.0, 1.0, 5.0, 5.0, 1.0, False), "none", 0.0),
        ((-4.0, 0.0, 1.0, 5.0, 5.0, 1.0, False), "return", 4.0),
        ((0.0, 0.0, 1.0, 9.0, 5.0, 1.0, None), "volume", 4.0),
        ((0.0, 0.0, 1.0, 1.0, 5.0, 1.0, False), "none", 4.0),
        ((0.0, 0.0, 1.0, 5.0, 5.0, 1.0, True), "volatility", 0.0),
        ((4.0, 0.0, 1.0, 9.0, 5.0, 1.0, False), "composite", 8.0),
        ((None, None, None, 5.0, 5.0, 0.0, None), "none", 0.0),
    ],
)
def test_label_and_score(spark, row, label, score):
    out = apply_rules(spark.createDataFrame([row], LABELLED), Rules(), run_id="r1").first()
    assert (out["anomaly_label"], out["anomaly_score"], out["run_id"]) == (label, score, "r1")


def test_ranking_limits_before_it_shuffles(spark):
    df = series(spark, [1.0] * 8).withColumns(
        {"trading_day": F.to_date("date"), "anomaly_label": F.lit("return"), "anomaly_score": F.col("row_index") % 3}
    )
    out = anomalies_ranked(df, top=3)
    assert [(r["row_index"], r["rank"]) for r in out.orderBy("rank").collect()] == [(2, 1), (5, 2), (1, 3)]
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
