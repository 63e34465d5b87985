import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barstats.operators.blocks import BLOCK, BLOCK_ROWS, HALO, grain, merge_blocks, over_series, split_series
from barstats.operators.intraday import DAY_KEYS, add_vol_regime, with_day
from helpers import plain_window, random_series, same_rows

SMALL = {"sample_every": 3, "samples_per_block": 8, "tiebreak": ("row_index",)}


def stage(window):
    frame = window.rowsBetween(-6, 0)
    return {
        "prev": F.lag("close", 2).over(window),
        "low": F.min("close").over(frame),
        "held": F.collect_list("row_index").over(frame),
    }


@pytest.fixture(scope="module")
def bars(spark):
    return random_series(spark, 4000).cache()


@pytest.mark.parametrize("keys", [("symbol",), ()])
@pytest.mark.parametrize("every", [1, 3])
def test_blocks_give_the_rows_of_a_whole_series(bars, keys, every):
    want = bars.withColumns(stage(plain_window(*keys)))
    got = over_series(bars, 6, stage, partition_cols=keys, **{**SMALL, "sample_every": every})
    assert same_rows(got, want)


def test_a_hot_series_is_spread_over_many_blocks(bars):
    parts = split_series(bars, 6, **SMALL)
    sizes = {
        (r["symbol"], r[BLOCK]): r["n"]
        for r in parts.groupBy("symbol", BLOCK).agg(F.count("*").alias("n")).collect()
    }
    hot = [n for (symbol, _), n in sizes.items() if symbol == "hot"]
    assert len(hot) > 5
    assert max(hot) < sum(hot) / 4
    assert same_rows(merge_blocks(parts), bars)


def test_every_block_but_the_first_has_the_whole_halo(bars):
    parts = split_series(bars, 6, **SMALL)
    per_block = parts.groupBy("symbol", BLOCK).agg(F.count_if(HALO).alias("halo"))
    first = F.min(BLOCK).over(Window.partitionBy("symbol"))
    later = per_block.withColumn("first", first).where(F.col(BLOCK) > F.col("first"))
    assert later.agg(F.min("halo")).first()[0] >= 6


def test_short_series_are_not_cut(bars):
    parts = split_series(bars, 6, tiebreak=("row_index",))
    assert parts.where(HALO).isEmpty()
    assert parts.select("symbol", BLOCK).distinct().count() == bars.select("symbol").distinct().count()


def test_an_instant_that_holds_a_third_of_all_rows_is_cut(spark):
    same = random_series(spark, 3000).withColumn(
        "date",
        F.when(F.col("row_index") % 3 == 0, F.lit("2020-01-05 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("date")),
    )
    one = same.withColumn("symbol", F.lit("one"))
    want = one.withColumns(stage(plain_window("symbol")))
    assert same_rows(over_series(one, 6, stage, **SMALL), want)
    crowded = split_series(one, 6, **SMALL).where("date = timestamp_ntz'2020-01-05 00:00:00'")
    assert crowded.select(BLOCK).distinct().count() > 3


def test_missing_times_and_symbols_are_kept(spark):
    bars = random_series(spark, 1500).withColumns(
        {
            "date": F.when(F.col("row_index") % 4 > 0, F.col("date")),
            "symbol": F.when(F.col("row_index") % 5 > 0, F.col("symbol")),
        }
    )
    want = bars.withColumns(stage(plain_window("symbol")))
    assert same_rows(over_series(bars, 6, stage, **SMALL), want)


def test_many_cuts_and_look_backs_longer_than_a_block(bars):
    small = {"sample_every": 1, "samples_per_block": 4, "tiebreak": ("row_index",)}
    assert split_series(bars, 1, **small).select("symbol", BLOCK).distinct().count() > 500
    for depth in (1, 40, 5000):
        want = bars.withColumn("prev", F.lag("close", depth).over(plain_window("symbol")))
        got = over_series(bars, depth, lambda w, d=depth: {"prev": F.lag("close", d).over(w)}, **small)
        assert same_rows(got, want)


def test_a_deep_look_back_does_not_need_long_blocks(spark):
    bars = random_series(spark, 20_000).withColumn("symbol", F.lit("one"))
    parts = split_series(bars, 100, sample_every=10, samples_per_block=100, tiebreak=("row_index",))
    sizes = [r["n"] for r in parts.groupBy(BLOCK).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 8 and max(sizes) < 5000


def test_chained_operators_share_the_cuts(spark, tmp_path):
    random_series(spark, 500).write.parquet(str(tmp_path / "bars"))
    out = spark.read.parquet(str(tmp_path / "bars"))
    for k in range(1, 5):
        out = over_series(out, 1, lambda w, k=k: {f"prev{k}": F.lag("close").over(w)}, tiebreak=("row_index",))
        plan = out._jdf.queryExecution().optimizedPlan().collectLeaves().size()
        scans = out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
        assert plan == 1 and scans <= k + 1
    whole = plain_window("symbol")
    want = spark.read.parquet(str(tmp_path / "bars")).withColumns(
        {f"prev{k}": F.lag("close").over(whole) for k in range(1, 5)}
    )
    assert same_rows(out, want)


def test_no_window_runs_over_the_rows_of_a_series(bars):
    parts = split_series(bars, 6, **SMALL)
    plan = parts._jdf.queryExecution().optimizedPlan().treeString()
    assert "Window" not in plan.split("scalar-subquery")[0]


def test_windows_over_windows_need_the_sum_of_their_depths(spark):
    bars = random_series(spark, 3000).where("close > 0")
    bars = bars.withColumn("date", F.col("date").cast("timestamp_ntz"))
    cut = add_vol_regime(bars, size=5, length=12, sample_every=2, samples_per_block=20, tiebreak=("row_index",))
    whole = add_vol_regime(bars, size=5, length=12, tiebreak=("row_index",))
    assert same_rows(cut.drop("realized_vol_5", "log_return", "simple_return"),
                     whole.drop("realized_vol_5", "log_return", "simple_return"))
    assert split_series(
        with_day(bars), 16, partition_cols=DAY_KEYS, sample_every=2, samples_per_block=20,
        tiebreak=("row_index",),
    ).select(*DAY_KEYS, BLOCK).distinct().count() > with_day(bars).select(*DAY_KEYS).distinct().count()


def test_a_split_table_is_not_split_again(bars):
    once = split_series(bars, 6, **SMALL)
    both = over_series(once, 6, stage, tiebreak=("row_index",))
    assert {BLOCK, HALO} <= set(both.columns)
    assert same_rows(merge_blocks(both), bars.withColumns(stage(plain_window("symbol"))))


def test_one_shuffle_of_the_rows(bars, spark):
    plan = over_series(
        spark.createDataFrame([], bars.schema), 6, stage, **SMALL
    )._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert main.count("Exchange hashpartitioning") <= 1


def test_negative_depth_is_refused(bars):
    with pytest.raises(ValueError):
        split_series(bars, -1)


@pytest.mark.parametrize("depth", [19, 1999])
def test_a_series_of_a_million_rows_is_in_blocks_by_default(spark, depth):
    """Blocks are far shorter than what fits a task, for deep look-backs and in a crowded hour too."""
    bars = spark.range(2_000_000).selectExpr(
        "'one' AS symbol", "timestamp_micros(id * 1000000 div 200) AS date", "id AS row_index"
    )
    parts = split_series(bars, depth, tiebreak=("row_index",))
    sizes = parts.groupBy(BLOCK).agg(F.count("*").alias("n"), F.count_if(HALO).alias("halo")).collect()
    assert sum(r["n"] - r["halo"] for r in sizes) == 2_000_000
    assert len(sizes) >= 3 and max(r["n"] for r in sizes) < 1_200_000
    assert min(r["halo"] for r in sizes if r[BLOCK]) >= depth


def test_blocks_do_not_grow_with_the_look_back():
    for depth in (1, 64, 390, 2000, 8000):
        every, per_block = grain(depth)
        assert every * per_block <= BLOCK_ROWS and depth <= per_block // 4
