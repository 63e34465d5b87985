"""Trailing mean and deviation over wide frames, at a cost that does not grow with the frame.

A window function over a trailing frame goes through the whole frame for every row. Here the
rows of a series are taken in chunks as long as the frame, so that a frame is the end of one chunk
and the beginning of the next. Running statistics from the beginning of a chunk, and from its end
backwards, cost a step a row; a frame's are those of its two parts put together. Counts,
means and squared deviations are only ever added to, never subtracted, so nothing is lost to
cancellation however long a series is and wherever its level lies; a frame whose least
and greatest values are equal has a deviation of exactly zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstats.functions import ratio

_ROW, _CHUNK, _X, _HEAD, _TAIL = "_row", "_chunk", "_x", "_head", "_tail"


def _running(window) -> Column:
    """Statistics from the beginning of the window to the current row."""
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.count(_X).over(frame)
    return F.struct(
        n.alias("n"),
        F.coalesce(F.avg(_X).over(frame), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(_X).over(frame) * n, F.lit(0.0)).alias("m2"),
        F.min(_X).over(frame).alias("lo"),
        F.max(_X).over(frame).alias("hi"),
    )


@dataclass(frozen=True)
class WideMoments:
    """A stage of :func:`over_series`: columns from the last ``size`` values of ``value``.

    ``mean`` and ``std`` (sample deviation) name the columns to add, and ``root_square`` one for the root of
    the sum of squares; NULL values are skipped.
    """

    value: str
    size: int
    mean: str | None = None
    std: str | None = None
    root_square: str | None = None

    def add_to(self, part: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        names = part.columns
        row = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
        rows = part.withColumns({_ROW: row, _X: F.col(self.value).cast("double")})
        rows = rows.withColumn(_CHUNK, F.floor(F.col(_ROW) / self.size))
        # The rows of a chunk are with those of its series already: these sort, but do not shuffle.
        chunk = Window.partitionBy(*keys, _CHUNK)
        rows = rows.withColumn(_TAIL, _running(chunk.orderBy(F.desc(_ROW))))
        rows = rows.withColumn(_HEAD, _running(chunk.orderBy(_ROW)))
        # In the order the rows have from the window before: they are not sorted again.
        behind = F.lag(_TAIL, self.size - 1).over(Window.partitionBy(*keys).orderBy(_CHUNK, _ROW))
        # At the end of its chunk a frame is the chunk.
        whole = F.col(_ROW) % self.size == self.size - 1
        rows = rows.withColumn(_TAIL, F.when(~whole, behind))

        a, b = F.col(_TAIL), F.col(_HEAD)
        a_n = F.coalesce(a["n"], F.lit(0))
        n = a_n + b["n"]
        share = F.coalesce(ratio(b["n"].cast("double"), n.cast("double")), F.lit(0.0))
        a_mean = F.coalesce(a["mean"], F.lit(0.0))
        apart = F.when(a_n > 0, b["mean"] - a_mean).otherwise(F.lit(0.0))
        mean = F.when(a_n > 0, a_mean + apart * share).otherwise(b["mean"])
        m2 = F.coalesce(a["m2"], F.lit(0.0)) + b["m2"] + apart * apart * a_n * share
        flat = F.least(a["lo"], b["lo"]) == F.greatest(a["hi"], b["hi"])
        std = F.when(flat, F.lit(0.0)).otherwise(F.sqrt(ratio(m2, (n - 1).cast("double"))))
        new = {
            self.mean: F.when(n > 0, mean),
            self.std: F.when(n > 1, std),
            self.root_square: F.when(n > 0, F.sqrt(m2 + mean * mean * n)),
        }
        new.pop(None, None)
        return rows.withColumns(new).select(*dict.fromkeys([*names, *new]))
