import pytest
from pyspark.sql import functions as F

from barstats.operators import rolling
from barstats.operators.blocks import over_series
from barstats.operators.wide import WideMoments
from helpers import column, plain_window, random_series, series

STAGE = {"mean": "m", "std": "s", "root_square": "r"}


def direct(bars, size):
    frame = plain_window("symbol").rowsBetween(1 - size, 0)
    x = F.col("close")
    return bars.withColumns(
        {"m": F.avg(x).over(frame), "s": F.stddev_samp(x).over(frame), "r": F.sqrt(F.sum(x * x).over(frame))}
    )


def assert_close(got, want, names=("m", "s", "r")):
    both = got.alias("a").join(want.alias("b"), ["symbol", "row_index"])
    assert both.count() == want.count() == got.count()
    for n in names:
        a, b = F.col(f"a.{n}"), F.col(f"b.{n}")
        same = (a.isNull() & b.isNull()) | (F.abs(a - b) <= 1e-9 * (1 + F.abs(b)))
        assert both.where(~F.coalesce(same, F.lit(False))).isEmpty(), n


@pytest.mark.parametrize("size", [2, 3, 7, 40, 500])
def test_agrees_with_a_window_over_the_frame(spark, size):
    bars = random_series(spark, 400)
    got = over_series(bars, size - 1, WideMoments("close", size, **STAGE), tiebreak=("row_index",))
    assert got.columns == [*bars.columns, "m", "s", "r"]
    assert_close(got, direct(bars, size))


def test_agrees_in_blocks(spark):
    bars = random_series(spark, 900)
    cut = {"tiebreak": ("row_index",), "sample_every": 2, "samples_per_block": 20}
    got = over_series(bars, 29, WideMoments("close", 30, **STAGE), **cut)
    assert_close(got, direct(bars, 30))


def test_flat_and_quiet_stretches_far_from_the_origin(spark):
    """No cancellation: a quiet stretch at a high level, behind a wild one, keeps its deviation."""
    wild = [1e9 * ((i * 7919) % 13) for i in range(100)]
    quiet = [1e6 + 1e-3 * (i % 2) for i in range(60)]
    bars = series(spark, [*wild, *quiet, *[0.1] * 60])
    got = over_series(bars, 19, WideMoments("close", 20, **STAGE))
    s = column(got, "s")
    assert s[140] == pytest.approx(5.13e-4, rel=1e-2)
    assert s[-1] == 0.0 and s[0] is None


def test_gaps_are_skipped(spark):
    got = over_series(series(spark, [None, None, 4.0, None, 6.0, None, None, None]), 2, WideMoments("close", 3, **STAGE))
    assert column(got, "m") == [None, None, 4.0, 4.0, 5.0, 6.0, 6.0, None]
    assert column(got, "s") == [None, None, None, None, pytest.approx(2**0.5), None, None, None]


def test_rolling_stats_take_it_from_a_width_on(spark):
    bars = random_series(spark, 300)
    wide = rolling.add_rolling_stats(bars, "close", rolling.WIDE, tiebreak=("row_index",))
    want = direct(bars, rolling.WIDE)
    names = wide.columns[-2:]
    assert_close(wide.withColumnsRenamed(dict(zip(names, "ms"))), want, "ms")


def test_rows_are_shuffled_once(spark):
    bars = spark.range(100).selectExpr("'S' AS symbol", "id AS date", "id AS row_index", "cast(id AS double) AS close")
    for stage in (WideMoments("close", 300, **STAGE), rolling.moments_stage("close", 20, mean="m")):
        keys, order = ["symbol"], ["date"]
        from pyspark.sql import Window

        out = (
            stage.add_to(bars, keys, order)
            if hasattr(stage, "add_to")
            else bars.withColumns(stage(Window.partitionBy(*keys).orderBy(*order)))
        )
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1


def test_a_row_is_sorted_three_times(spark):
    """By time, and by chunk backwards and forwards: the last of these orders serves the look behind too."""
    bars = spark.range(100).selectExpr("'S' AS symbol", "id AS date", "id AS row_index", "cast(id AS double) AS close")
    out = WideMoments("close", 300, **STAGE).add_to(bars, ["symbol"], ["date"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 3
