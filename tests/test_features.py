import pytest
from pyspark.sql import functions as F

from barstats.operators.features import (
    add_candle_body,
    add_features,
    add_price_range,
    add_rolling_return,
    add_simple_return,
)
from helpers import column, series


@pytest.mark.parametrize(
    "closes,want",
    [
        ([100.0, 110.0], [None, 0.1]),
        ([100.0, 90.0], [None, -0.1]),
        ([100.0, 100.0], [None, 0.0]),
        ([0.0, 5.0, 10.0], [None, None, 1.0]),
    ],
)
def test_simple_return(spark, closes, want):
    got = column(add_simple_return(series(spark, closes)), "simple_return")
    assert got == [None if w is None else pytest.approx(w) for w in want]


def test_return_follows_time_and_not_insertion(spark):
    bars = series(spark, [100.0, 110.0, 121.0]).orderBy(F.desc("date"))
    assert column(add_simple_return(bars), "simple_return")[1:] == pytest.approx([0.1, 0.1])


def test_each_symbol_starts_anew_unless_pooled(spark):
    a, b = series(spark, [10.0, 20.0], "A"), series(spark, [40.0, 80.0], "B")
    both = a.unionByName(b.withColumn("date", F.col("date") + F.expr("interval 1 hour")))
    assert column(add_simple_return(both), "simple_return") == [None, 1.0, None, 1.0]
    assert column(add_simple_return(both, partition_cols=()), "simple_return") == [None, 1.0, 1.0, 1.0]


def test_range_and_signed_body(spark):
    df = spark.createDataFrame(
        [(10.0, 12.0, 9.0, 11.0), (11.0, 12.0, 9.0, 10.0), (10.0, 10.5, 9.5, 10.0)],
        "open double, high double, low double, close double",
    )
    assert [r["price_range"] for r in add_price_range(df).collect()] == [3.0, 3.0, 1.0]
    assert [r["candle_body"] for r in add_candle_body(df).collect()] == [1.0, -1.0, 0.0]


def test_add_features_keeps_rows_and_adds_three_columns(spark):
    bars = series(spark, [1.0, 2.0, 3.0]).withColumns({c: F.col("close") for c in ("open", "high", "low")})
    out = add_features(bars)
    assert out.columns == [*bars.columns, "simple_return", "price_range", "candle_body"]
    assert out.count() == 3


def test_rolling_return(spark):
    got = column(add_rolling_return(series(spark, [10.0, 11.0, 12.0, 15.0]), bars=2), "close_return_2")
    assert got == [None, None, pytest.approx(0.2), pytest.approx(4 / 11)]
    with pytest.raises(ValueError):
        add_rolling_return(series(spark, [1.0]), bars=0)
