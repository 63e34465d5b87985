import pytest
from pyspark.sql import functions as F

from barstats.plans.pipeline import flagship, run_intraday, run_pipeline
from barstats.schema import ENRICHED_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from barstats.sources import layout, scratch
from barstats.sources.bars import explore_csv, read_enriched, read_ohlcv_csv
from barstats.sources.scratch import discard, new_folder, shared_folder, staged
from helpers import same_rows
from test_clean import GOOD, bar, raw


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "bars.csv"
    lines = [",".join(RAW_COLUMNS)]
    for i in range(30):
        close = 100 + 0.5 * i
        lines.append(
            f"{i},20200102  {9 + (30 + i) // 60:02d}:{(30 + i) % 60:02d}:00,{close - 0.2},{close + 0.3},"
            f"{close - 0.4},{close},{1000 + i},10,{close - 0.1}"
        )
    path.write_text("\n".join(lines) + "\n")
    return path


def test_csv_file_or_folder(spark, csv):
    assert read_ohlcv_csv(csv, spark).schema == RAW_SCHEMA
    assert read_ohlcv_csv(csv.parent, spark).count() == 30
    assert dict(explore_csv(str(csv), spark).dtypes)["close"] == "double"


def test_missing_path_is_found_out_at_once(spark, tmp_path):
    for read in (read_ohlcv_csv, explore_csv, read_enriched):
        with pytest.raises(FileNotFoundError):
            read(str(tmp_path / "nowhere"), spark)


def test_malformed_rows_and_changed_headers_fail(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    (tmp_path / "bad.csv").write_text(f"{header}\n1,20200102  09:30:00,x,1,1,1,1,1,1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_ohlcv_csv(tmp_path / "bad.csv", spark).collect()
    swapped = header.replace("open,high", "high,open")
    (tmp_path / "swap.csv").write_text(f"{swapped}\n1,20200102  09:30:00,1,1,1,1,1,1,1\n")
    with pytest.raises(Exception, match="header|HEADER"):
        read_ohlcv_csv(tmp_path / "swap.csv", spark).collect()
    assert read_ohlcv_csv(tmp_path / "swap.csv", spark, check_header=False).count() == 1


def test_pipeline_from_file_to_tables(spark, csv, tmp_path):
    lake, table = str(tmp_path / "lake"), str(tmp_path / "table")
    out = run_pipeline(spark, str(csv), lake, table, symbol="SPY")
    assert out.columns == list(ENRICHED_COLUMNS)[:9] + ["symbol"] + [
        c for c in out.columns if c not in RAW_COLUMNS and c != "symbol"
    ]
    assert set(out.columns) == set(ENRICHED_COLUMNS)
    assert out.count() == 30
    assert read_enriched(table, spark).where("trading_day = '2020-01-02'").count() == 30
    assert not (tmp_path / "lake").exists()


def test_pipeline_of_several_symbols(spark, csv, tmp_path):
    keyed = read_ohlcv_csv(csv, spark)
    two = keyed.withColumn("symbol", F.lit("A")).unionByName(keyed.withColumn("symbol", F.lit("B")))
    two.write.option("header", True).csv(str(tmp_path / "keyed"))
    out = run_pipeline(spark, str(tmp_path / "keyed"), str(tmp_path / "lake"))
    assert {(r["symbol"], r["count"]) for r in out.groupBy("symbol").count().collect()} == {("A", 30), ("B", 30)}
    assert out.where("simple_return IS NULL").count() == 2


def test_a_day_can_be_run_again(spark, csv, tmp_path):
    keyed = read_ohlcv_csv(csv, spark).withColumn("symbol", F.lit("A"))
    bad = keyed.limit(1).withColumns({"row_index": F.lit(99).cast("long"), "date": F.lit("oops")})
    keyed = keyed.unionByName(bad)
    keyed.write.option("header", True).csv(str(tmp_path / "keyed"))
    for run in ("one", "two"):
        tables = run_intraday(spark, str(tmp_path / "keyed"), str(tmp_path / "root"), run_id=run)
    for path in (tables.bars, tables.anomalies):
        got = read_enriched(path, spark)
        assert got.count() == 30 and {r["run_id"] for r in got.collect()} == {"two"}
    assert [r["row_index"] for r in read_enriched(tables.quarantine, spark).collect()] == [99]


def test_staged_and_lazy_chain_agree(spark, csv):
    tagged = read_ohlcv_csv(csv, spark).withColumn("symbol", F.lit("S"))
    assert same_rows(flagship(tagged), flagship(tagged, stage=False))


@pytest.fixture
def bars(spark):
    rows = [bar(row_index=i, date=f"2008010{d}  09:3{i}:00") for d in (3, 4, 5) for i in range(4)]
    return raw(spark, *rows).withColumns(
        {"symbol": F.lit("S"), "date": F.to_timestamp_ntz("date", F.lit("yyyyMMdd  HH:mm:ss"))}
    )


def test_day_folders_prune(spark, bars, tmp_path):
    layout.load_table(bars, str(tmp_path / "t"))
    assert {p.name for p in (tmp_path / "t").glob("trading_day=*")} == {f"trading_day=2008-01-0{d}" for d in (3, 4, 5)}
    kept = layout.retained(spark.read.parquet(str(tmp_path / "t")), 1, as_of="2008-01-05")
    assert kept.count() == 8
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trading_day" in plan
    assert layout.retained(bars, None, as_of="2008-01-05") is bars


def test_append_adds_and_overwrite_replaces(spark, bars, tmp_path):
    path = str(tmp_path / "t")
    layout.load_table(bars, path)
    layout.load_table(bars, path)
    assert spark.read.parquet(path).count() == 24
    layout.load_table(bars.limit(3), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_only_the_days_written_are_replaced(spark, bars, tmp_path):
    path = str(tmp_path / "t")
    layout.load_table(bars, path)
    one = bars.where("to_date(date) = '2008-01-04'").limit(1).withColumn("volume", F.lit(7).cast("long"))
    layout.load_table(one, path, mode="overwrite", only_days_written=True)
    counts = {str(r[0]): r[1] for r in spark.read.parquet(path).groupBy("trading_day").count().collect()}
    assert counts == {"2008-01-03": 4, "2008-01-04": 1, "2008-01-05": 4}
    with pytest.raises(ValueError):
        layout.load_table(one, path, only_days_written=True)


def test_layout_can_be_turned_off(spark, bars, tmp_path):
    layout.load_table(bars, str(tmp_path / "t"), partition_field=None, clustering_fields=None)
    out = spark.read.parquet(str(tmp_path / "t"))
    assert out.columns == bars.columns and out.count() == 12


def test_scratch_is_the_sessions_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(f"{shared_folder(spark)}/barstats-{spark.sparkContext.applicationId}/")


def test_discard_deletes_own_tables_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "run_folder", lambda spark: str(tmp_path / "run"))
    spark.range(3).write.parquet(str(tmp_path / "other"))
    assert not discard(spark)
    assert staged(spark.range(5), "x").count() == 5
    assert discard(spark) and not (tmp_path / "run").exists()
    assert spark.read.parquet(str(tmp_path / "other")).count() == 3


def test_rows_of_another_schema_are_not_added(spark, tmp_path):
    path = str(tmp_path / "table")
    bars = spark.createDataFrame([("S", 1.0)], "symbol string, close double").withColumn(
        "date", F.lit("2020-01-02 09:30:00").cast("timestamp_ntz")
    )
    layout.load_table(bars, path, "append")
    layout.load_table(bars, path, "append")
    for odd in (bars.withColumn("close", F.lit("x")), bars.withColumn("more", F.lit(1)), bars.drop("close")):
        with pytest.raises(ValueError, match="other columns or types"):
            layout.load_table(odd, path, "append")
    with pytest.raises(ValueError):
        layout.load_table(bars.drop("close"), path, "overwrite", only_days_written=True)
    assert spark.read.parquet(path).count() == 2
