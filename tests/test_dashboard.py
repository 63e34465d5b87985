import pytest
from pyspark.sql import functions as F

from barstats.operators import daily, histograms, profile
from barstats.plans.dashboard import ROLLED, Z, charts
from barstats.plans.pipeline import Settings, enrich
from helpers import random_series


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    bars = random_series(spark, 6000).withColumns(
        {
            "date": (F.col("date").cast("timestamp") + F.expr("make_interval(0, 0, 0, cast(row_index % 90 as int))")).cast("timestamp_ntz"),
            "open": F.col("close"),
            "high": F.when(F.col("row_index") % 11 > 0, F.col("close") + 1).otherwise(F.lit(float("nan"))),
            "low": F.when(F.col("row_index") % 7 > 0, F.col("close") - 1),
            "close": F.when(F.col("row_index") % 50 == 0, 900.0).otherwise(F.col("close")),
            "volume": F.col("row_index") % 1000,
            "average": F.col("close"),
        }
    )
    path = str(tmp_path_factory.mktemp("charts") / "bars")
    enrich(bars, Settings(relative_error=0.0), tiebreak=("row_index",)).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    """Rows with numbers rounded: sums are added up in another order."""
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_charts_are_what_the_single_operators_give(table):
    want = {
        "price_trend": daily.price_trend(table),
        "daily_zscore": daily.daily_series(table, Z),
        "daily_rolling_stats": daily.daily_means(table, ROLLED),
        "hist_close_by_iqr": histograms.histogram_by_flag(table),
        "hist_log_volume": histograms.histogram_log(table),
        "feature_correlation": profile.correlation_matrix(table),
        "daily_anomaly_counts": daily.daily_anomaly_counts(table),
        "monthly_anomaly_counts": daily.monthly_anomaly_counts(table),
        "top_days_combined": daily.top_days_combined(table),
    }
    got = charts(table)
    assert list(got) == list(want)
    for name, df in want.items():
        assert got[name].columns == df.columns, name
        assert rows(got[name]) == rows(df), name
    assert not want["price_trend"].where("series <> 'daily_mean_close'").isEmpty()


def test_charts_read_the_bars_at_most_five_times(table):
    reads = 0
    for df in charts(table).values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        reads += plan.count("/bars]")
    assert reads <= 4  # and once for the summary


def test_charts_of_an_empty_table(table):
    for name, df in charts(table.limit(0)).items():
        assert df.isEmpty() or name == "feature_correlation"
