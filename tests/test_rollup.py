import pytest
from pyspark.sql import functions as F

from barstats.functions import trading_day
from barstats.operators import rollup
from barstats.schema import IQR_FLAG, Z_FLAG
from barstats.sources.layout import DAY, load_table
from helpers import random_series, same_rows


@pytest.fixture(scope="module")
def bars(spark):
    """Three days of bars in two symbols, with gaps and a symbol of one day."""
    rows = random_series(spark, 600, hot_share=0.9)
    late = F.col("date") + F.make_dt_interval(days=(F.col("row_index") % 3).cast("int"))
    rows = rows.withColumns(
        {
            "date": late.cast("timestamp_ntz"), "open": F.col("close") - 1, "high": F.col("close") + 1,
            "low": F.col("close") - 2, "volume": F.col("row_index"), "simple_return": F.col("close") / 100,
            Z_FLAG: F.when(F.col("row_index") % 11 > 0, F.col("row_index") % 7 == 0), IQR_FLAG: F.col("close") > 90,
        }
    )
    return rows.cache()


def make(path, **options):
    return rollup.Rollup(str(path), tiebreak=("row_index",), **options)


def days_of(bars):
    return sorted(r[0] for r in bars.select(trading_day(F.col("date"))).distinct().collect())


def test_days_added_one_by_one_give_what_all_give(spark, bars, tmp_path):
    whole, parts = make(tmp_path / "whole"), make(tmp_path / "parts")
    whole.add(bars)
    for day in [*days_of(bars), days_of(bars)[0]]:  # the first comes twice
        parts.add(bars.where(trading_day(F.col("date")) == F.lit(day)))
    a, b = (r.read(spark).drop("sketch").select(whole.read(spark).drop("sketch").columns) for r in (whole, parts))
    assert same_rows(a.drop("measures"), b.drop("measures"))
    assert rollup.merged_quantiles(parts.read(spark), (0.5,)).first()["n"] == bars.where("close IS NOT NULL").count()


def test_refresh_reads_the_folders_of_its_days_only(spark, bars, tmp_path):
    lake, kept = tmp_path / "lake", make(tmp_path / "kept")
    load_table(bars, str(lake), "overwrite")
    first, *others = days_of(bars)
    for day in others:  # files of other days cannot even be opened
        for file in (lake / f"{DAY}={day}").glob("*.parquet"):
            file.write_bytes(b"not a table")
    kept.refresh(spark, str(lake), [first])
    assert [r[DAY] for r in kept.read(spark).select(DAY).distinct().collect()] == [first]


def test_moments_merge_to_those_of_all_rows(spark):
    rows = spark.range(900).select(
        (F.col("id") % 9).alias("part"), (F.lit(1e8) + F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("x")
    ).withColumn("x", F.when(F.col("part") != 3, F.col("x")))
    parts = rows.groupBy("part").agg(rollup.moments("x").alias("m"))
    got = parts.agg(rollup.merged_moments(F.collect_list("m")).alias("m")).first()["m"]
    n, mean, std = rows.agg(F.count("x"), F.avg("x"), F.stddev_samp("x")).first()
    assert got["n"] == n and got["mean"] == pytest.approx(mean, rel=1e-14)
    assert (got["m2"] / (n - 1)) ** 0.5 == pytest.approx(std, rel=1e-9)


def test_merged_quantiles_are_within_the_error(spark, bars, tmp_path):
    kept = make(tmp_path / "kept", relative_error=0.02)
    kept.add(bars)
    for by in ([], ["symbol"]):
        got = rollup.merged_quantiles(kept.read(spark), (0.25, 0.5, 0.9), by=by)
        ranked = bars.where("close IS NOT NULL").join(got, by) if by else bars.where("close IS NOT NULL").crossJoin(got)
        for i, p in enumerate((0.25, 0.5, 0.9)):
            edge = F.col("quantiles")[i]
            held = ranked.groupBy(*by).agg(
                (F.count_if(F.col("close") < edge) / F.count("*")).alias("below"),
                (F.count_if(F.col("close") <= edge) / F.count("*")).alias("upto"),
            )
            for row in held.collect():
                # A small group's rank may be off by one of its rows.
                assert row["below"] <= p + 0.02 + 0.05 and row["upto"] >= p - 0.02


def test_results_of_a_rollup(spark, bars, tmp_path):
    kept = make(tmp_path / "kept")
    kept.add(bars)
    table = kept.read(spark)
    flagged = bars.where(F.coalesce(F.col(Z_FLAG), F.lit(False)) | F.coalesce(F.col(IQR_FLAG), F.lit(False)))
    assert rollup.top_days_combined(table).agg(F.sum("anomaly_count")).first()[0] == flagged.count()
    months = rollup.monthly_anomaly_counts(table).first()
    assert months["iqr"] == bars.where(IQR_FLAG).count() and months["zscore"] == bars.where(Z_FLAG).count()
    counts = rollup.rolling_anomaly_counts(table, "iqr", window_days=2)
    assert counts.count() == table.count()
    assert rollup.top_anomaly_days(table, "zscore", 1).count() == 1
    top = rollup.highest_volatility_symbols(table, 1).first()
    want = bars.groupBy("symbol").agg(F.stddev_samp("simple_return").alias("s")).orderBy(F.desc_nulls_last("s")).first()
    assert (top["symbol"], top["return_volatility"]) == (want["symbol"], pytest.approx(want["s"], rel=1e-9))


def test_empty_bars_and_bars_without_values(spark, bars, tmp_path):
    kept = make(tmp_path / "kept")
    kept.add(bars.withColumn("close", F.lit(None).cast("double")))
    assert rollup.merged_quantiles(kept.read(spark), (0.5,)).isEmpty()
    assert rollup.daily_series(kept.read(spark), "close").isEmpty()
    before = kept.read(spark).count()
    kept.add(bars.limit(0))
    assert kept.read(spark).count() == before


@pytest.mark.parametrize("error", [0, -1, 2, 1e-9])
def test_errors_that_no_sketch_keeps(error):
    with pytest.raises(ValueError):
        rollup.sketch_size(error)

