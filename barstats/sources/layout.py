"""Writing bar tables, with the layout readers prune by."""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Sequence
from functools import reduce
from typing import Literal
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from barstats.functions import trading_day
from barstats.schema import IQR_FLAG, SYMBOL, TS, Z_FLAG

DAY = "trading_day"
_DAY_NAME = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
_SUMMARY_TYPES = {"first_bar": "timestamp_ntz", "last_bar": "timestamp_ntz"}


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, if there is one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def check_schema(df: DataFrame, path: str) -> None:
    """Refuse to add to a table of other columns or types. There may be none yet."""
    there = existing(df.sparkSession, path)
    if there is None:
        return
    has = {n: t for n, t in there.dtypes if n != DAY}
    gets = {n: t for n, t in df.dtypes if n != DAY}
    if has != gets:
        odd = sorted(n for n in {*has, *gets} if has.get(n) != gets.get(n))
        raise ValueError(f"{path} has other columns or types: {', '.join(odd)}")


def load_table(
    df: DataFrame,
    path: str,
    mode: Literal["append", "overwrite"] = "append",
    *,
    partition_field: str | None = TS,
    clustering_fields: Sequence[str] | None = (SYMBOL,),
    only_days_written: bool = False,
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Write a table by day, clustered within each file.

    Rows are rebalanced on the day: Spark merges small days into a task and splits
    a crowded one, so no day is written by one task for its size. Day folders serve
    partition pruning; the sort gives row groups a narrow range of the clustering
    columns. Either can be turned off with ``None``. ``only_days_written`` replaces
    the days that ``df`` has and leaves the others alone. Rows of another schema are not
    added to a table. ``observed`` counts the rows as they are written: behind the last shuffle, where a
    task that is run again counts once.
    """
    if only_days_written and (mode != "overwrite" or not partition_field):
        raise ValueError("replacing single days needs mode='overwrite' and a partition field")
    if mode == "append" or only_days_written:
        check_schema(df, path)
    order = list(clustering_fields or ())
    if partition_field:
        df = df.withColumn(DAY, trading_day(F.col(partition_field))).hint("rebalance", DAY)
        order = [DAY, *order, partition_field]
    if order:
        df = df.sortWithinPartitions(*dict.fromkeys(order))
    if observed:
        df = df.observe(observed[0], *observed[1])
    writer = df.write.mode(mode)
    if partition_field:
        writer = writer.partitionBy(DAY)
    if only_days_written:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def upsert(
    df: DataFrame, path: str, key: Sequence[str] = (SYMBOL, TS), *, ts: str = TS, newest: Sequence[str] = ()
) -> None:
    """Add bars to a table by day, in the place of those with the same key.

    Doing it again changes nothing, so a load can be repeated. The key has the time, so only the days
    that arrive are read and written. Of bars that arrive with one key the last in the order of ``newest``
    stays, then of all columns. NULL is equal to NULL in a key; a bar without a time is refused.
    """
    if ts not in key:
        raise ValueError(f"the key must have {ts}, or days that do not arrive would be looked through")
    order = [F.col(c).desc_nulls_last() for c in dict.fromkeys([*newest, *df.columns])]
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    dated = df.where(F.when(F.col(ts).isNotNull(), True).otherwise(F.raise_error(F.lit("a bar without a time")).cast("boolean")))
    fresh = dated.withColumn("_nth", first).where("_nth = 1").drop("_nth")
    there = existing(df.sparkSession, path)
    if there is not None:
        check_schema(df, path)
        # The calendar bounds the days.
        days = fresh.select(trading_day(F.col(ts)).alias(DAY)).distinct()
        held = there.join(F.broadcast(days), DAY, "left_semi")
        same = reduce(Column.__and__, [held[c].eqNullSafe(fresh[c]) for c in key])
        fresh = fresh.unionByName(held.join(fresh.select(*key), same, "left_anti").select(*df.columns))
    load_table(fresh, path, "overwrite", partition_field=ts, only_days_written=True)


def retained(df: DataFrame, days: int | None, as_of: str, day: str = DAY) -> DataFrame:
    """The days not older than ``days`` before ``as_of``; all of them for None.

    On a table written by day this prunes folders and reads nothing of the others.
    """
    if days is None:
        return df
    return df.where(F.col(day) >= F.date_sub(F.lit(as_of).cast("date"), days))


def expire(spark: SparkSession, path: str, days: int | None, as_of: str) -> list[str]:
    """Delete the folders of days older than ``days`` before ``as_of``, and say which.

    Only folders of days are looked at, and nothing is read. ``None`` keeps all.
    """
    if days is None:
        return []
    oldest = dt.date.fromisoformat(as_of) - dt.timedelta(days=days)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for entry in files.listStatus(root):
        name, _, day = entry.getPath().getName().partition("=")
        if entry.isDirectory() and name == DAY and _DAY_NAME.fullmatch(day) and dt.date.fromisoformat(day) < oldest:
            files.delete(entry.getPath(), True)
            gone.append(day)
    return sorted(gone)


def write_bucketed(df: DataFrame, path: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Write a table in buckets of its key, sorted, and read it back.

    Two tables in as many buckets of the same key meet in a join, and are grouped by it, without a
    shuffle. The table is known by its path: its name in the catalog is given up again.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid4().hex}"
    writer = df.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*by)
    writer.option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return table


def write_quarantine(df: DataFrame, path: str, mode: str = "append", ts: str = TS) -> None:
    """Rejected bars by day and reason."""
    by = [DAY, "reason"]
    (
        df.withColumn(DAY, trading_day(F.col(ts)))
        .hint("rebalance", *by)
        .sortWithinPartitions(*by)
        .write.mode(mode)
        .partitionBy(*by)
        .parquet(path)
    )


def _summary(z_flag: str, iqr_flag: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("processed_row_count"),
        F.count_if(F.col(z_flag)).alias("zscore_anomalies"),
        F.count_if(F.col(iqr_flag)).alias("iqr_anomalies"),
        F.min(TS).alias("first_bar"),
        F.max(TS).alias("last_bar"),
    ]


def run_summary(df: DataFrame, z_flag: str = Z_FLAG, iqr_flag: str = IQR_FLAG) -> DataFrame:
    """One row about a finished run."""
    return df.agg(*_summary(z_flag, iqr_flag), F.countDistinct(SYMBOL).alias("symbols"))


def write_run_summary(df: DataFrame, path: str) -> None:
    """The summary as JSON, with the time it was made."""
    stamped = run_summary(df).withColumn("generated_at", F.current_timestamp())
    stamped.write.mode("overwrite").json(path)


def load_with_summary(
    df: DataFrame, path: str, summary: str, z_flag: str = Z_FLAG, iqr_flag: str = IQR_FLAG, **layout
) -> DataFrame:
    """Write a table with :func:`load_table`, and a summary of the run as JSON; read the table back.

    The summary's counts are taken as the rows are written, so what the table was made from is read
    once. Only the number of symbols, which is no running count, comes from that column of the new
    table. The summary also has the seconds that the writing took and where the rows went.
    """
    seen, began = Observation(), time.monotonic()
    load_table(df, path, observed=(seen, _summary(z_flag, iqr_flag)), **layout)
    seconds, spark = time.monotonic() - began, df.sparkSession
    table = spark.read.parquet(path)
    symbols = table.agg(F.countDistinct(SYMBOL).alias("symbols"))
    counts = [F.lit(v).cast(_SUMMARY_TYPES.get(k, "long")).alias(k) for k, v in seen.get.items()]
    record = symbols.select(*counts, "symbols", F.lit(path).alias("output"), F.lit(seconds).alias("seconds"))
    record.withColumn("generated_at", F.current_timestamp()).write.mode("overwrite").json(summary)
    return table
