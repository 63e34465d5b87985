"""The place of each value among the last ones, a row at a time.

A moving order statistic has no built-in function that carries on from row to row: a window
function over a trailing frame sees the whole frame for every row. Here rows pass in their
order, and a frame is kept as two halves around the wanted place, each a heap, so a row
costs a few steps of a heap whatever the length of the frame.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import floor, inf

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

_FIRST = "_first"


class SlidingQuantile:
    """Tells of each value whether it is above the quantile of the last ``length``, its own included.

    The interpolated quantile lies between two neighbours in the sorted frame, of which a
    value of the frame that is above the lower one can only be the upper one or beyond: so a value is above
    the quantile exactly if it is above the lower neighbour. ``low`` holds the values up to
    that one, ``high`` the others. Values that have left the frame go when they surface,
    or all at once when they are the larger part of a heap.
    """

    def __init__(self, length: int, quantile: float):
        self.length, self.quantile = length, quantile
        self.restart()

    def restart(self) -> None:
        self.row = 0
        self.frame: deque[int] = deque()
        #: Where each row of the frame is: True for low.
        self.side: dict[int, bool] = {}
        self.low: list[tuple[float, int]] = []
        self.high: list[tuple[float, int]] = []
        self.n_low = 0

    def _top(self, heap: list, low: bool) -> tuple[float, int]:
        side = self.side
        while side.get(heap[0][1]) is not low:
            heapq.heappop(heap)
        return heap[0]

    def _tidy(self) -> None:
        for heap, low in ((self.low, True), (self.high, False)):
            if len(heap) > 64 + 2 * len(self.side):
                heap[:] = [x for x in heap if self.side.get(x[1]) is low]
                heapq.heapify(heap)

    def above(self, value: float | None) -> bool | None:
        """Take the next row; None for a row without a value, which fills its place all the same."""
        row = self.row = self.row + 1
        frame, side = self.frame, self.side
        if frame and frame[0] <= row - self.length:
            self.n_low -= side.pop(frame.popleft())
        if value is None:
            return None
        if value != value:
            value = inf  # NaN is above all numbers
        frame.append(row)
        if self.n_low and value <= -self._top(self.low, True)[0]:
            heapq.heappush(self.low, (-value, row))
            side[row] = True
            self.n_low += 1
        else:
            heapq.heappush(self.high, (value, row))
            side[row] = False
        wanted = floor((len(side) - 1) * self.quantile) + 1
        while self.n_low > wanted:
            negative, moved = self._top(self.low, True)
            heapq.heappop(self.low)
            heapq.heappush(self.high, (-negative, moved))
            side[moved] = False
            self.n_low -= 1
        while self.n_low < wanted:
            number, moved = self._top(self.high, False)
            heapq.heappop(self.high)
            heapq.heappush(self.low, (-number, moved))
            side[moved] = True
            self.n_low += 1
        self._tidy()
        return value > -self._top(self.low, True)[0]


@dataclass(frozen=True)
class RowStage:
    """A stage of :func:`over_series` that goes through the rows of a series in order.

    ``make`` gives a function for each task; it gets (first, value) of every row, first being
    True where a series (or a block of one) begins, and gives the row's new value.
    """

    source: str
    name: str
    make: Callable[[], Callable[[bool, float | None], bool | None]]

    def add_to(self, part: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        # The window function brings the rows of a series into one task and in order.
        window = Window.partitionBy(*keys).orderBy(*order)
        marked = part.withColumn(_FIRST, F.row_number().over(window) == 1)
        kept = [f for f in part.schema.fields if f.name != self.name]
        names, source, make = [f.name for f in kept], self.source, self.make

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = make()
            for batch in batches:
                firsts, values = batch.column(_FIRST).to_pylist(), batch.column(source).to_pylist()
                new = pa.array(list(map(step, firsts, values)), pa.bool_())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), new], [*names, "new"])

        out = StructType([*kept, StructField("new", BooleanType())])
        return marked.mapInArrow(run, out).withColumnRenamed("new", self.name)


def above_quantile(column: str, name: str, length: int, quantile: float) -> RowStage:
    """Whether the column is above its quantile over the last ``length`` rows, interpolated; NULL for NULL."""

    def make():
        frame = SlidingQuantile(length, quantile)

        def step(first: bool, value: float | None) -> bool | None:
            if first:
                frame.restart()
            return frame.above(value)

        return step

    return RowStage(column, name, make)
