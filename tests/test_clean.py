from datetime import datetime

import pytest

from barstats.operators.clean import between_times, clean, drop_incomplete, flagged, parse_time
from barstats.schema import RAW_COLUMNS, RAW_SCHEMA
from helpers import column

GOOD = (1, "20080103  09:31:00", 147.0, 148.0, 146.0, 147.5, 1000, 10, 147.2)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def bar(**changes):
    return tuple({**dict(zip(RAW_COLUMNS, GOOD, strict=True)), **changes}.values())


def test_wholly_equal_rows_become_one(spark):
    assert clean(raw(spark, GOOD, GOOD)).count() == 1
    assert clean(raw(spark, GOOD, bar(row_index=2))).count() == 2


def test_time_is_parsed_as_wall_clock(spark):
    out = clean(raw(spark, GOOD))
    assert dict(out.dtypes)["date"] == "timestamp_ntz"
    assert out.first()["date"] == datetime(2008, 1, 3, 9, 31)


@pytest.mark.parametrize(
    "text", ["garbage", "20080103 09:31:00", "20081303  09:31:00", "20080103  25:31:00", "20080230  09:31:00", "", None]
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_out_of_format_is_null_whatever_the_mode(spark, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert parse_time(raw(spark, bar(date=text))).first()["date"] is None
        assert clean(raw(spark, bar(date=text))).isEmpty()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_a_time_that_daylight_saving_skips_is_kept(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = parse_time(raw(spark, bar(date="20080309  02:30:00")))
        assert out.selectExpr("cast(date as string) d").first()["d"] == "2008-03-09 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", ["open", "close", "volume", "average", "row_index"])
def test_rows_with_a_gap_go(spark, name):
    out = clean(raw(spark, GOOD, bar(row_index=9, **({name: None} if name != "row_index" else {}))
                    if name != "row_index" else bar(row_index=None)))
    assert out.count() == 1


def test_nan_counts_as_a_gap(spark):
    assert drop_incomplete(raw(spark, bar(close=float("nan")))).isEmpty()


def test_output_is_in_time_order(spark):
    rows = [bar(row_index=i, date=f"20080103  09:{m}:00") for i, m in enumerate((32, 30, 31))]
    assert [r["date"].minute for r in clean(raw(spark, *rows)).collect()] == [30, 31, 32]


def test_an_end_without_time_is_midnight(spark):
    rows = [bar(row_index=i, date=d) for i, d in enumerate(
        ("20200309  00:00:00", "20200312  15:59:00", "20200313  00:00:00", "20200313  09:30:00"))]
    kept = between_times(parse_time(raw(spark, *rows)), "2020-03-09", "2020-03-13")
    assert column(kept, "row_index") == [0, 1, 2]


def test_a_null_flag_is_neither_true_nor_false(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, f boolean")
    assert [r["id"] for r in flagged(df, "f").collect()] == [1]
    assert [r["id"] for r in flagged(df, "f", value=False).collect()] == [2]
