import math

import pytest
from pyspark.sql import functions as F

from barstats.operators import checks, histograms, profile
from barstats.schema import CHART_COLUMNS, RAW_SCHEMA
from test_clean import GOOD, bar, raw
from helpers import series


def test_schema_must_agree_wholly(spark):
    good = raw(spark, GOOD)
    checks.validate_schema(good)
    for other in (
        good.withColumn("extra", F.lit(1)),
        good.drop("average"),
        good.withColumn("volume", F.col("volume").cast("int")),
        good.select(*reversed(good.columns)),
    ):
        with pytest.raises(ValueError):
            checks.validate_schema(other)


def test_required_numeric_and_empty(spark):
    good = raw(spark, GOOD)
    checks.validate_required_columns(good)
    checks.validate_numeric_columns(good.drop("open"))
    checks.validate_not_empty(good)
    with pytest.raises(ValueError, match="close"):
        checks.validate_required_columns(good.drop("close"))
    with pytest.raises(ValueError, match="nope"):
        checks.validate_required_columns(good, ["nope"])
    with pytest.raises(ValueError, match="high"):
        checks.validate_numeric_columns(good.withColumn("high", F.lit("x")))
    with pytest.raises(ValueError):
        checks.validate_not_empty(raw(spark))
    with pytest.raises(ValueError, match="simple_return"):
        checks.validate_chart_columns(good)
    assert len(CHART_COLUMNS) == 15


def test_report_says_what_fails(spark):
    df = raw(spark, GOOD, bar(close=None), bar(high=math.nan)).drop("average")
    lines = {r["check"]: (r["passed"], r["detail"]) for r in checks.data_quality_report(df).collect()}
    assert lines["required_columns"] == (False, "average")
    assert lines["not_empty"] == (True, "3")
    assert lines["missing:close"] == (False, "1")
    assert lines["missing:high"] == (False, "1")
    assert lines["missing:open"] == (True, "0")
    assert not lines["schema"][0]
    assert [r[0] for r in checks.data_quality_report(raw(spark), RAW_SCHEMA).where("not passed").collect()] == ["not_empty"]


def test_histogram_has_every_bin_and_closes_the_last(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 9, 10)] + [(None,)], "x double")
    rows = histograms.histogram(df, F.col("x"), 5).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [3, 0, 0, 0, 2]
    assert (rows[0]["lower"], rows[-1]["upper"]) == (0.0, 10.0)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    rows = histograms.histogram(df, F.col("x"), 10).where("count > 0").collect()
    assert [(r["bin"], r["count"]) for r in rows] == [(5, 2)]


def test_histogram_by_flag_uses_each_sides_range(spark):
    df = spark.createDataFrame(
        [(1.0, False), (3.0, False), (100.0, True), (200.0, True), (7.0, None)],
        "close double, close_iqr_anomaly boolean",
    )
    out = histograms.histogram_by_flag(df, bins=2).orderBy("close_iqr_anomaly", "bin").collect()
    assert [(r["lower"], r["count"]) for r in out] == [(1.0, 1), (2.0, 1), (100.0, 1), (150.0, 1)]


def test_log_histogram_counts_positive_volumes_in_edges_minus_one_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 10, 100, 1000)], "volume long")
    rows = histograms.histogram_log(df, edges=4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [1, 1, 2]


def test_correlation_pairs_only_complete_rows(spark):
    pandas = pytest.importorskip("pandas")
    rows = [(1.0, 2.0, 5.0, None), (2.0, 4.5, 5.0, 1.0), (3.0, None, 5.0, None), (4.0, 7.0, 5.0, None), (None, 1.0, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    want = pandas.DataFrame(rows, columns=list("abcd")).corr()
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df, list("abcd")).collect()}
    assert len(got) == 16
    for (a, b), r in got.items():
        expected = want.loc[a, b]
        if math.isnan(expected):
            assert r is None
        else:
            assert r == pytest.approx(expected, rel=1e-9)


def test_correlation_far_from_zero(spark):
    df = spark.range(2000).select((F.col("id") * 1e-3 + 1e9).alias("a"), (F.col("id") * -2e-3 + 1e9).alias("b"))
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert got["a", "b"] == pytest.approx(-1.0, abs=1e-6)


def test_describe_and_boxplot(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "close double")
    row = profile.describe(df).first()
    assert (row["count"], row["mean"], row["p25"], row["p50"], row["p75"]) == (5, 22.0, 2.0, 3.0, 4.0)
    box = profile.boxplot_stats(df, "close").first()
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 4.0, 1)


def test_duplicates_nulls_and_shape(spark):
    df = raw(spark, GOOD, GOOD, GOOD, bar(close=None))
    assert tuple(profile.duplicate_count(df).first()) == (4, 2)
    assert {r["column"]: r["missing"] for r in profile.null_counts(df).collect()}["close"] == 1
    assert tuple(profile.shape(df).first()) == (4, 9)
    assert profile.schema_listing(df)[0] == ("row_index", "bigint")


def test_sample_is_whole_and_repeatable(spark):
    df = spark.range(5000)
    once = {r[0] for r in profile.sample_rows(df, 300, ["id"]).collect()}
    again = {r[0] for r in profile.sample_rows(df.repartition(5), 300, ["id"]).collect()}
    assert len(once) == 300 and once == again
    assert profile.sample_rows(df.limit(20), 300, ["id"]).count() == 20


def test_return_distribution(spark):
    row = profile.return_distribution(series(spark, [1.0, 2.0, 3.0, 4.0, None]), "close").first()
    assert row["n"] == 4 and row["skewness"] == pytest.approx(0)
    assert row["jarque_bera"] == pytest.approx(4 / 6 * row["excess_kurtosis"] ** 2 / 4)


def test_correlation_leaves_out_pairs_with_nan(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, float("nan")), (4.0, 8.3), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    full = df.where("a IS NOT NULL AND NOT isnan(b)")
    assert got["a", "b"] == pytest.approx(full.stat.corr("a", "b"))
    assert got["a", "a"] == pytest.approx(1.0) and got["b", "b"] == pytest.approx(1.0)


def test_log_bins_are_not_rounded_unless_asked(spark):
    df = spark.createDataFrame([(1,), (7,), (1000,)], "volume long")
    top = histograms.histogram_log(df, edges=4).agg(F.max("upper")).first()[0]
    assert top == pytest.approx(3.0)
    rough = histograms.histogram_log(df.where("volume < 10"), edges=4, digits=1)
    assert rough.agg(F.max("upper")).first()[0] == pytest.approx(0.8)
