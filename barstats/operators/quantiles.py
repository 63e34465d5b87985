"""Exact quantiles without gathering a group's values anywhere.

Spark's own exact percentiles keep every distinct value of a group in one
buffer. Here the first pass over the values builds a sketch of each group, whose ranks
are off by a share of ``1 / accuracy`` at most; it gives a bracket around every wanted
quantile, some errors wide. The second pass counts: values in a bracket one by one, those
between brackets in one cell each, combined map-side, so that only a few rows in a hundred thousand
are ever shuffled. Sums over the cells then say which row has the wanted rank: the
result is exact, whatever the distribution, the magnitudes and the number of copies.

Counts verify the brackets. Should a rank lie in a cell between them, which the bound of the
sketch excludes, a third pass takes that cell's values one by one; without such a cell
there is nothing to join with, and Spark leaves the pass out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
#: Errors of the sketch on each side of a quantile that its bracket spans.
REACH = 3

_ALL = "_all"


def _ranks(prob: float, n: Column, interpolate: bool) -> tuple[Column, Column, Column]:
    """One-based ranks on both sides of a quantile, and the weight of the upper one."""
    if not interpolate:
        rank = F.greatest(F.ceil(F.lit(prob) * n), F.lit(1)).cast("long")
        return rank, rank, F.lit(0.0)
    place = F.lit(prob) * (n - 1)
    return (
        (F.floor(place) + 1).cast("long"),
        (F.ceil(place) + 1).cast("long"),
        place - F.floor(place),
    )


def _brackets(values: DataFrame, keys: list[str], probs: Sequence[float], accuracy: int, reach: float) -> DataFrame:
    """A row per group: how many values, and the ends of the bracket of each quantile."""
    off = reach / accuracy
    ends = [[max(0.0, p - off), min(1.0, p + off)] for p in probs]
    sketch = F.percentile_approx("_v", [e for pair in ends for e in pair], accuracy)
    return values.groupBy(*keys).agg(F.count("*").alias("_n"), sketch.alias("_ends"))


def _counted(values: DataFrame, held: Column, cell: Column, keys: list[str], carried: list[str]) -> DataFrame:
    """Rows of values counted by cell, and within a cell by what ``held`` gives."""
    # Grouping by a struct of the keys keeps the join's partitioning from serving the
    # aggregation too: counts are combined before their own shuffle, and Spark stays
    # free to split a crowded group in the join.
    counted = values.groupBy(
        F.struct(*keys).alias("_group"), *carried, cell.alias("_cell"), held.alias("_held")
    ).agg(F.count("*").alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    return counted.select("_group.*", *[c for c in counted.columns if c != "_group"])


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    *,
    by: Sequence[str] = (),
    interpolate: bool = False,
    few_groups: bool | None = None,
    accuracy: int = ACCURACY,
    reach: float = REACH,
) -> DataFrame:
    """One row per group: the ``by`` columns, ``n`` and ``quantiles`` (as ``probs``).

    NULL and NaN are left out; a group without values has no row. ``few_groups``
    says that the number of groups is fixed by the caller and not by the data, so
    that the brackets may be broadcast; without it Spark picks the join by size.
    """
    if accuracy < 1 or reach < 0:
        raise ValueError(f"accuracy must be at least 1 and reach not negative, got {accuracy} and {reach}")
    keys = list(by) or [_ALL]
    few_groups = not by if few_groups is None else few_groups
    small = F.broadcast if few_groups else (lambda d: d)

    values = df.select(
        *(by or [F.lit(0).alias(_ALL)]), F.col(value).cast("double").alias("_v")
    ).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    sides = [_ranks(p, F.col("_n"), interpolate) for p in probs]
    ranks = F.array_distinct(F.array(*[r for lo, hi, _ in sides for r in (lo, hi)]))

    # A value's cell is the number of ends below it, so cells are in the order of their values.
    v = F.col("_v")
    begun = reduce(Column.__add__, [(v >= F.col("_ends")[2 * i]).cast("int") for i in range(len(probs))])
    ended = reduce(Column.__add__, [(v > F.col("_ends")[2 * i + 1]).cast("int") for i in range(len(probs))])
    marked = values.join(small(_brackets(values, keys, probs, accuracy, reach)), keys)
    cells = _counted(marked, F.when(begun > ended, v), begun + ended, keys, ["_n"])

    def with_ranks(rows: DataFrame, series: list[str], below: Column) -> DataFrame:
        """Rows with the wanted ranks among their values, and how many values come before."""
        order = Window.partitionBy(*series).orderBy("_cell", "_held").rowsBetween(Window.unboundedPreceding, -1)
        before = rows.withColumn("_before", below + F.coalesce(F.sum("_rows").over(order), F.lit(0)))
        return before.withColumn("_rank", F.explode("_wanted")).where(
            (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_rows"))
        )

    first = with_ranks(cells.withColumn("_wanted", ranks), keys, F.lit(0).cast("long"))
    # The least and the greatest value of a cell are known without its others.
    found = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
    found = found.when(F.col("_rank") == F.col("_before") + 1, F.col("_lo"))
    found = found.when(F.col("_rank") == F.col("_before") + F.col("_rows"), F.col("_hi"))
    first = first.withColumn("_found", found).select(*keys, "_n", "_rank", "_found", "_before", "_lo", "_hi")
    missed = first.where("_found IS NULL").groupBy(*keys, "_n", "_before", "_lo", "_hi").agg(
        F.collect_set("_rank").alias("_wanted")
    )
    missed = missed.withColumnsRenamed({"_lo": "_from", "_hi": "_to"})
    again = values.join(small(missed), keys).where((v >= F.col("_from")) & (v <= F.col("_to")))
    carried = ["_n", "_before", "_wanted"]
    again = _counted(again, v, F.lit(0), keys, carried).withColumnRenamed("_before", "_under")
    again = with_ranks(again, [*keys, "_under"], F.col("_under"))

    both = first.where("_found IS NOT NULL").select(*keys, "_n", "_rank", "_found")
    both = both.unionByName(again.select(*keys, "_n", "_rank", F.col("_lo").alias("_found")))
    picked = both.groupBy(*keys, "_n").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_found"))).alias("_at")
    )

    def quantile(lo: Column, hi: Column, weight: Column) -> Column:
        low = F.try_element_at("_at", lo)
        if not interpolate:
            return low
        return F.when(weight == 0, low).otherwise(
            low + weight * (F.try_element_at("_at", hi) - low)
        )

    return picked.select(
        *by, F.col("_n").alias("n"), F.array(*[quantile(*s) for s in sides]).alias("quantiles")
    )
