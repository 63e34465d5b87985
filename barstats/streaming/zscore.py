"""Rolling z-scores on a stream, from Spark's keyed state.

A trailing window needs only the last ``window - 1`` values of a series from before a
batch: a ring of them is the state of the series, next to the bars that still wait for
earlier ones. Spark keeps it in its state store, gives a batch the state of the series
it touches, writes output and state exactly once, and carries on from the checkpoint.

Every series has a time of its own: its latest bar, less ``delay``. Bars come out in order when that
passes them, however far other series are ahead. The stream's watermark lies ``idle`` behind the
latest bar of all and only says which series have ended: a timer at a series' last time
brings out what waits, and its state goes. A bar of a series after that starts it anew.

No bar is lost: one without a time, and one that comes too late for its windows, comes
out with a reason. A null column value is skipped by the window, as NaN is here. A task holds
one batch's bars of one series at a time, as Arrow columns of some bytes a value; limit the files of a
trigger to bound them. Bars come out of the state in chunks, a row with an array for each column, which
Spark takes apart again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from barstats.functions import mean_name, std_name, zscore_flag_name, zscore_name
from barstats.operators.rolling import add_rolling_stats, check_size
from barstats.operators.zscore import detect_zscore_anomalies
from barstats.schema import SYMBOL, TS, WINDOW, Z_THRESHOLD
from barstats.sources.layout import existing

REASON = "reason"
_AT = "_at"
_EVENT = "_event"
#: So many bars leave the state as one row.
CHUNK = 4096
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The last values, the latest time seen, the time up to which bars have come out, and the timer.
_SERIES = StructType(
    [
        StructField("ring", ArrayType(DoubleType())),
        StructField("seen", LongType()),
        StructField("out", LongType()),
        StructField("timer", LongType()),
    ]
)


def trailing_scores(ring: Sequence[float | None], values: Sequence[float | None], window: int):
    """Mean, deviation and score of each value over the last ``window``, the ring being in front.

    Arrays with NaN for what is not there. Sums are taken from the greatest value of the
    frame, so that a flat frame has a deviation of exactly zero and hence no score.
    """
    if not len(values):
        return (np.zeros(0),) * 3
    gaps = [None] * (window - 1 - len(ring))
    every = np.concatenate([np.array([*gaps, *ring], dtype=float), np.asarray(values, dtype=float)])
    frames = np.lib.stride_tricks.sliding_window_view(every, window)
    mean, std = np.full(len(values), np.nan), np.full(len(values), np.nan)
    for a in range(0, len(values), 8192):
        frame = frames[a : a + 8192]
        there = ~np.isnan(frame)
        n = there.sum(1)
        top = np.where(there, frame, -np.inf).max(1)
        top[n == 0] = np.nan
        off = np.where(there, frame - top[:, None], 0.0)
        center = off.sum(1) / np.where(n > 0, n, np.nan)
        square = np.where(there, (off - center[:, None]) ** 2, 0.0).sum(1)
        mean[a : a + 8192] = top + center
        std[a : a + 8192] = np.sqrt(square / np.where(n > 1, n - 1, np.nan))
    own = every[window - 1 :]
    score = (own - mean) / np.where(std > 0, std, np.nan)
    return mean, std, score


class Bars:
    """Bars in order of arrival, as Arrow columns: a small part of what as many Python rows take."""

    def __init__(self, schema: StructType):
        self.schema = to_arrow_schema(schema)
        self.parts: list[pa.RecordBatch] = []
        self.fresh: list[Sequence] = []

    def add(self, values: Sequence) -> None:
        self.fresh.append(values)
        if len(self.fresh) == CHUNK:
            self._pack()

    def _pack(self) -> None:
        columns = [pa.array(v, f.type) for v, f in zip(zip(*self.fresh), self.schema)]
        self.parts.append(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.fresh = []

    def table(self) -> pa.Table:
        if self.fresh:
            self._pack()
        return pa.Table.from_batches(self.parts, self.schema)


def in_order(bars: pa.Table, tiebreak: Sequence[str]) -> np.ndarray:
    """The places of bars in the order of their time and tie-break, nulls first; equal ones as they came."""
    keys = [(c, "ascending") for c in dict.fromkeys([_AT, *tiebreak])]
    if not any(pa.types.is_nested(bars.schema.field(c).type) for c, _ in keys):
        return pc.sort_indices(bars.select([c for c, _ in keys]), keys, null_placement="at_start").to_numpy()
    columns = [bars.column(c).to_pylist() for c, _ in keys]
    places = [tuple((v is not None, v) if v is not None else (False,) for v in row) for row in zip(*columns)]
    return np.array(sorted(range(len(places)), key=places.__getitem__), dtype=np.int64)


class SeriesScores(StatefulProcessor):
    """The state of each series, and what comes out of it."""

    def __init__(self, stream: ZScoreStream, bars: StructType, delay: int):
        self.stream, self.delay = stream, delay
        self.names = [f for f in bars.names if f != _AT]
        self.waits = bars

    def init(self, handle) -> None:
        self.handle = handle
        self.series = handle.getValueState("series", _SERIES)
        self.waiting = handle.getListState("waiting", self.waits)

    def _out(self, bars: pa.Table, reason: str | None = None, scores: Sequence[pa.Array] = ()) -> Iterator[Row]:
        """Bars in chunks, with their scores or with a reason."""
        for a in range(0, bars.num_rows, CHUNK):
            chunk = bars.slice(a, CHUNK).combine_chunks()
            n = chunk.num_rows
            own = {c: chunk.column(c).combine_chunks() for c in self.names}
            added = [x.slice(a, n) for x in scores] or [[None] * n for _ in self.stream.added]
            yield Row(**own, **dict(zip(self.stream.added, added)), **{REASON: [reason] * n})

    def _scored(self, ring: list, bars: pa.Table) -> Iterator[Row]:
        """Score bars in order, and move the ring on behind them."""
        window = self.stream.window
        bars = bars.combine_chunks()
        order = in_order(bars, self.stream.tiebreak)
        column = bars.column(self.stream.column)
        values = pc.cast(column, pa.float64(), safe=False).to_numpy()[order]
        mean, std, score = (pa.array(x, from_pandas=True) for x in trailing_scores(ring, values, window))
        flag = pc.greater(pc.abs(score), self.stream.threshold)
        for a in range(0, len(order), CHUNK):
            scores = [x.slice(a, CHUNK) for x in (mean, std, score, flag)]
            yield from self._out(bars.take(order[a : a + CHUNK]), scores=scores)
        last = column.take(order[max(0, len(order) + 1 - window) :]).to_pylist()
        ring[:] = [None if v is None else float(v) for v in [*ring, *last][1 - window :]]

    def _held(self) -> Bars:
        held = Bars(self.waits)
        if self.waiting.exists():
            for values in self.waiting.get():
                held.add(values)
        return held

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.series.get() if self.series.exists() else None
        ring, seen, out, timer = (list(known[0]), *known[1:]) if known else ([], None, None, None)
        # What lies behind the watermark may belong to a series that has ended.
        ended = timerValues.getCurrentWatermarkInMs() * 1000 or None
        limit = out if known else ended
        held, aside = self._held(), {r: Bars(self.waits) for r in ("bad_timestamp", "late")}
        had, came = bool(held.parts or held.fresh), False
        for row in rows:
            row = row.asDict()
            at, values = row[_AT], [row[c] for c in self.waits.names]
            if at is None:
                aside["bad_timestamp"].add(values)
            elif limit is not None and at <= limit:
                aside["late"].add(values)
            else:
                held.add(values)
                came = True
                seen = at if seen is None else max(seen, at)
        for reason, bars in aside.items():
            yield from self._out(bars.table(), reason)
        if not came:
            return
        out = max(t for t in (seen - self.delay, limit) if t is not None)
        bars, held, aside = held.table(), None, None
        ready = pc.less_equal(bars.column(_AT), out)
        rest, bars = bars.filter(pc.invert(ready)), bars.filter(ready)
        if bars.num_rows:
            yield from self._scored(ring, bars)
        if had:
            self.waiting.clear()
        for part in rest.to_batches(CHUNK):
            self.waiting.appendList([tuple(row.values()) for row in part.to_pylist()])
        due = seen // 1000
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.series.update((ring, seen, out, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.series.get() if self.series.exists() else None
        if known is None or known[3] != expiredTimerInfo.getExpiryTimeInMs():
            return
        if self.waiting.exists():
            yield from self._scored(list(known[0]), self._held().table())
            self.waiting.clear()
        self.series.clear()

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class ZScoreStream:
    """``delay`` is an interval: how long a bar may come after a later one of its series.

    Bars of a series are scored in the order of their time. One at or before the time up to which its
    series has come out is late, and goes to the rejects, as one without a time does. With a
    delay the last bars wait for newer ones, or for :meth:`finish`. ``idle`` is an interval: a
    series that is this far behind the latest bar of all has ended.
    """

    output: str
    column: str = "close"
    window: int = WINDOW
    threshold: float = Z_THRESHOLD
    delay: str = "0 seconds"
    idle: str = "30 days"
    ts: str = TS
    partition_cols: Sequence[str] = (SYMBOL,)
    tiebreak: Sequence[str] = ()

    def __post_init__(self):
        check_size(self.window)

    @property
    def added(self) -> tuple[str, ...]:
        """The columns that scores add."""
        return tuple(
            name(self.column, self.window) for name in (mean_name, std_name, zscore_name, zscore_flag_name)
        )

    @property
    def _finished(self) -> str:
        return f"{self.output}-finished"

    def _micros(self) -> Column:
        """A bar's time in microseconds, as the wall clock has it."""
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{self.ts}`)")

    def scored(self, bars: DataFrame) -> DataFrame:
        """The stream of bars with their scores, or with a reason why they have none."""
        at = bars.withColumn(_AT, self._micros())
        marked = at.withColumn(_EVENT, F.timestamp_micros(_AT)).withWatermark(_EVENT, self.idle)
        # Without the column of the watermark Spark passes late bars on, and the series decides.
        rows = marked.drop(_EVENT)
        seconds = bars.sparkSession.range(1).select(
            F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {self.delay}"))
        )
        kinds = (DoubleType(), DoubleType(), DoubleType(), BooleanType(), StringType())
        new = [StructField(n, k) for n, k in zip((*self.added, REASON), kinds)]
        processor = SeriesScores(self, rows.schema, seconds.first()[0])
        out = StructType([*bars.schema.fields, *new])
        chunk = StructType([StructField(f.name, ArrayType(f.dataType)) for f in out])
        chunks = rows.groupBy(*self.partition_cols).transformWithState(processor, chunk, "Append", "EventTime")
        return chunks.select(F.inline(F.arrays_zip(*(f"`{n}`" for n in out.names)))).toDF(*out.names)

    def start(self, bars: DataFrame, checkpoint: str) -> StreamingQuery:
        """Score everything that has arrived, and stop. Start again to go on."""
        spark = bars.sparkSession
        before = spark.conf.get(_PROVIDER)
        spark.conf.set(_PROVIDER, _ROCKSDB)
        try:  # the query takes a copy of the settings as it starts
            return (
                self.scored(bars)
                .writeStream.format("parquet")
                .option("path", self.output)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
        finally:
            spark.conf.set(_PROVIDER, before)

    def finish(self, spark: SparkSession, checkpoint: str) -> None:
        """Score the bars that still wait for newer ones, from the state the stream has left.

        The stream has ended with them: doing it again gives the same, and going on after it would
        bring them out twice. The batch operators score them, behind the values of the rings.
        """
        state = spark.read.format("statestore").option("path", checkpoint)
        waiting = state.option("stateVarName", "waiting").load().select("list_element.*").drop(_AT)
        rings = state.option("stateVarName", "series").load().select("key.*", F.posexplode("value.ring"))
        # Ring values stand in front of all bars, in their order.
        first = F.coalesce(waiting.agg(F.min(self.ts)).scalar(), F.lit("1970-01-01").cast(waiting.schema[self.ts].dataType))
        ahead = F.make_dt_interval(secs=F.lit(self.window) - F.col("pos"))
        front = rings.select(
            *self.partition_cols, F.col("col").alias(self.column), (first - ahead).alias(self.ts)
        )
        rows = waiting.withColumn("_new", F.lit(True)).unionByName(front, allowMissingColumns=True)
        series = {"ts": self.ts, "partition_cols": self.partition_cols, "tiebreak": self.tiebreak}
        rolled = add_rolling_stats(rows, self.column, self.window, **series)
        out = detect_zscore_anomalies(rolled, self.column, self.window, self.threshold).where("_new")
        out = out.drop("_new").withColumn(REASON, F.lit(None).cast("string"))
        out.write.mode("overwrite").parquet(self._finished)

    def _all(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.parquet(self.output)
        rest = existing(spark, self._finished)
        return rows if rest is None else rows.unionByName(rest)

    def read(self, spark: SparkSession) -> DataFrame:
        """The bars scored so far."""
        return self._all(spark).where(F.col(REASON).isNull()).drop(REASON)

    def read_rejects(self, spark: SparkSession) -> DataFrame:
        """The bars set aside so far, with a reason."""
        return self._all(spark).where(F.col(REASON).isNotNull()).drop(*self.added)
