"""Loads that are repeated, observed, expired, bucketed; bars that arrive more than once."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from barstats.operators import views
from barstats.schema import IQR_FLAG, Z_FLAG
from barstats.sources import layout
from barstats.streaming import ingest
from helpers import START, same_rows, series


def days(spark, n):
    """A bar on each of n days from 2 January 2020."""
    return series(spark, [float(i) for i in range(n)]).withColumn(
        "date", (F.col("date") + F.make_dt_interval(days=F.col("row_index").cast("int"))).cast("timestamp_ntz")
    )


class Arrivals:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.lake = spark, folder, f"{folder}/lake"

    def put(self, bars, **options):
        bars.write.mode("append").parquet(f"{self.folder}/in")
        arriving = self.spark.readStream.schema(bars.schema).parquet(f"{self.folder}/in")
        query = ingest.ingest_available(arriving, self.lake, f"{self.folder}/checkpoint", **options)
        query.awaitTermination()
        return query

    def rows(self):
        return sorted(r["row_index"] for r in self.spark.read.parquet(self.lake).collect())


def test_bars_are_added_once_whenever_they_come(spark, tmp_path):
    arrivals, bars = Arrivals(spark, str(tmp_path)), days(spark, 6)
    arrivals.put(bars.where("row_index < 3").unionByName(bars.limit(2)))
    arrivals.put(bars.where("row_index in (1, 3, 4)"))
    arrivals.put(bars)
    assert arrivals.rows() == [0, 1, 2, 3, 4, 5]
    # A bar that differs in one column is another bar.
    arrivals.put(bars.where("row_index = 5").withColumn("close", F.lit(None).cast("double")))
    assert arrivals.rows() == [0, 1, 2, 3, 4, 5, 5]


def test_batches_do_not_read_the_table(spark, tmp_path, monkeypatch):
    arrivals, bars, compared = Arrivals(spark, str(tmp_path)), days(spark, 4), []
    monkeypatch.setattr(ingest, "add_new_bars", lambda *a: compared.append(a))
    arrivals.put(bars.where("row_index < 2"))
    arrivals.put(bars.where("row_index in (0, 2, 3)"))
    assert arrivals.rows() == [0, 1, 2, 3] and not compared


def test_a_batch_that_is_run_again_adds_nothing_twice(spark, tmp_path):
    arrivals, bars = Arrivals(spark, str(tmp_path)), days(spark, 4)
    arrivals.put(bars.where("row_index < 2"))
    # The second batch has begun, and written, but the stream has not noted that it ended.
    (tmp_path / "checkpoint-begun" / "1").touch()
    (tmp_path / "checkpoint-begun" / "2").touch()
    layout.load_table(bars.where("row_index = 2"), arrivals.lake, "append")
    arrivals.put(bars.where("row_index >= 2"))
    assert arrivals.rows() == [0, 1, 2, 3]


def test_bars_far_behind_are_counted(spark, tmp_path):
    arrivals, bars = Arrivals(spark, str(tmp_path)), days(spark, 10)
    arrivals.put(bars.where("row_index > 8"), within="2 days")
    query = arrivals.put(bars.where("row_index in (1, 8)"), within="2 days")
    assert arrivals.rows() == [8, 9] and ingest.bars_too_late(query) == 1


def test_an_upsert_can_be_repeated(spark, tmp_path):
    path, bars = str(tmp_path / "t"), days(spark, 4)
    layout.upsert(bars.where("row_index < 3"), path)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("trading_day=2020-01-02/*.parquet")}
    changed = bars.where("row_index >= 2").withColumn("close", F.col("close") * 10)
    for _ in range(3):
        layout.upsert(changed.unionByName(bars.where("row_index = 2")), path, newest=("close",))
    want = bars.where("row_index < 2").unionByName(changed)
    assert same_rows(spark.read.parquet(path).select(bars.columns), want)
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())


def test_an_upsert_knows_null_keys_and_refuses_bars_without_a_time(spark, tmp_path):
    path = str(tmp_path / "t")
    bars = days(spark, 2).withColumn("symbol", F.when(F.col("row_index") > 0, F.col("symbol")))
    for _ in range(2):
        layout.upsert(bars, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="date"):
        layout.upsert(bars, path, key=("symbol",))
    with pytest.raises(Exception, match="without a time"):
        layout.upsert(bars.withColumn("date", F.lit(None).cast("timestamp_ntz")), path)
    layout.upsert(bars.limit(0), path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="other columns"):
        layout.upsert(bars.withColumn("close", F.lit("x")), path)


def test_old_days_are_deleted_and_others_untouched(spark, tmp_path):
    path = str(tmp_path / "t")
    layout.load_table(days(spark, 5), path, "overwrite")
    (tmp_path / "t" / "trading_day=__HIVE_DEFAULT_PARTITION__").mkdir()
    (tmp_path / "t" / "other=2000-01-01").mkdir()
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet") if "01-05" in str(p) or "01-06" in str(p)}
    assert layout.expire(spark, path, None, "2020-01-06") == []
    assert layout.expire(spark, path, 1, "2020-01-06") == ["2020-01-02", "2020-01-03", "2020-01-04"]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")} == kept
    assert (tmp_path / "t" / "other=2000-01-01").exists()
    assert layout.expire(spark, path, 1, "2020-01-06") == []


def test_a_summary_is_taken_while_the_table_is_written(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            read.add(1)
            yield row

    bars = days(spark, 6).withColumns({Z_FLAG: F.col("row_index") == 2, IQR_FLAG: F.lit(None).cast("boolean")})
    counted = spark.createDataFrame(bars.rdd.mapPartitions(seen), bars.schema)
    table = layout.load_with_summary(counted, str(tmp_path / "t"), str(tmp_path / "s"), mode="overwrite")
    assert read.value == 6 and same_rows(table.drop("trading_day").select(bars.columns), bars)
    record = json.loads("".join(p.read_text() for p in (tmp_path / "s").glob("part*.json")))
    assert record["processed_row_count"] == 6 and record["symbols"] == 1
    assert record["zscore_anomalies"] == 1 and record["iqr_anomalies"] == 0
    assert record["seconds"] > 0 and record["output"] == str(tmp_path / "t")


def test_tables_in_buckets_join_without_a_shuffle(spark, tmp_path):
    bars = days(spark, 50)
    flags = bars.where("row_index % 2 = 0").select("symbol", "date", "row_index", F.lit("x").alias("anomaly_label"))
    key = ("row_index", "symbol", "date")
    a, b = (layout.write_bucketed(t, str(tmp_path / n), key, 4) for t, n in ((bars, "a"), (flags, "b")))
    joined = views.intraday_returns(a, b.hint("merge"), key=key)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert same_rows(joined.drop("anomaly_label").select(bars.columns), bars.where("row_index % 2 = 0"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_single_tables_in_buckets(spark, tmp_path, n):
    bars = series(spark, [1.0], start=START + timedelta(days=1)).limit(n)
    assert layout.write_bucketed(bars, str(tmp_path / "t"), ["symbol"], 4).count() == n
