"""Bars arriving as files, added to the Parquet lake by day, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from barstats.operators.clean import drop_incomplete, parse_time
from barstats.functions import trading_day
from barstats.schema import KEYED_SCHEMA, TS
from barstats.sources.layout import DAY, existing, load_table

#: How long a bar is remembered, and may come late.
WITHIN = "30 days"
_EVENT = "_event"


def stream_raw_csv(
    spark: SparkSession,
    folder: str,
    schema: StructType = KEYED_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """CSV bar files, each read once as it appears."""
    reader = spark.readStream.schema(schema).option("header", True).option("mode", "FAILFAST")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def clean_stream(raw: DataFrame) -> DataFrame:
    """The row-wise part of cleaning, which needs no state: parse, drop incomplete rows."""
    return raw.transform(parse_time).transform(drop_incomplete)


def add_new_bars(bars: DataFrame, lake: str, ts: str = TS) -> None:
    """Add the bars that the lake does not have yet, without repeats, to their days.

    Only the days between the first and the last of the bars are looked at. Rows that were
    added before are left out, so a batch that is run again adds nothing twice.
    """
    spark = bars.sparkSession
    fresh = bars.dropDuplicates()
    first, last = bars.agg(F.min(trading_day(F.col(ts))), F.max(trading_day(F.col(ts)))).first()
    if first is None:
        return
    if (there := existing(spark, lake)) is not None:
        there = there.where(F.col(DAY).between(F.lit(first), F.lit(last)))
        same = None
        for c in bars.columns:
            equal = fresh[c].eqNullSafe(there[c])
            same = equal if same is None else same & equal
        fresh = fresh.join(there, same, "left_anti")
    load_table(fresh, lake, "append", partition_field=ts)


def once(bars: DataFrame, within: str = WITHIN, ts: str = TS) -> DataFrame:
    """The stream without bars that have come before, which Spark's state store knows.

    A bar is known until the stream is ``within`` past its time. One that comes later than that is
    left out, and counted by :func:`bars_too_late`.
    """
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    timed = bars.withColumn(_EVENT, F.timestamp_micros(micros)).withWatermark(_EVENT, within)
    return timed.dropDuplicatesWithinWatermark(bars.columns).drop(_EVENT)


def bars_too_late(query: StreamingQuery) -> int:
    """How many bars of a run came behind the time that the state store reaches back."""
    return sum(o.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for o in p["stateOperators"])


def ingest_available(bars: DataFrame, lake: str, checkpoint: str, within: str = WITHIN) -> StreamingQuery:
    """Add everything that has arrived to the table by day, each bar once, and stop.

    Neither the stream nor its batches read the table. A batch that a failure cut short has left
    a mark beside the checkpoint; as it is run again, and then only, its days are compared.
    """

    def write(batch: DataFrame, number: int) -> None:
        if begun(batch.sparkSession, f"{checkpoint}-begun/{number}"):
            add_new_bars(batch, lake)
        else:
            load_table(batch, lake, "append")

    return (
        once(bars, within)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def begun(spark: SparkSession, mark: str) -> bool:
    """Leave a mark; whether it was there before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(mark)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        return True
    files.mkdirs(path.getParent())
    return not files.createNewFile(path)
