"""Equal-width histograms: the range first, then one counting pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from barstats.schema import IQR_FLAG

_ALL = "_all"


def histogram(
    df: DataFrame,
    value: Column,
    bins: int,
    by: str | None = None,
    extremes: DataFrame | None = None,
) -> DataFrame:
    """``by``, ``bin``, ``lower``, ``upper``, ``count``: every bin, empty ones too.

    The bins span the smallest to the largest value of the group, whose top edge
    belongs to the last bin. A group with a single value gets a range of width 1
    around it. ``by`` must be a column of few values fixed beforehand (a flag, a
    column name): its ranges are broadcast. ``extremes`` (the group, least, greatest: a row
    for each group) saves the pass that finds them.
    """
    group = F.lit(0) if by is None else F.col(by)
    name = by or _ALL
    values = df.select(group.alias(name), value.cast("double").alias("_x")).where(
        F.col(name).isNotNull() & F.col("_x").isNotNull() & ~F.isnan("_x")
    )
    if extremes is None:
        extremes = values.groupBy(name).agg(F.min("_x").alias("least"), F.max("_x").alias("greatest"))
    elif by is None:
        extremes = extremes.withColumn(_ALL, F.lit(0))
    low, high = F.col("least"), F.col("greatest")
    spread = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    ranges = extremes.where(low.isNotNull()).select(
        name, (low - spread).alias("_lo"), (high + spread).alias("_hi")
    )
    ranges = ranges.select(
        name, "_lo", ((F.col("_hi") - F.col("_lo")) / F.lit(bins)).alias("_width")
    )
    place = F.floor((F.col("_x") - F.col("_lo")) / F.col("_width"))
    counts = (
        values.join(F.broadcast(ranges), name)
        .groupBy(name, F.least(place, F.lit(bins - 1).cast("long")).cast("int").alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    all_bins = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return all_bins.join(counts, [name, "bin"], "left").select(
        *([] if by is None else [by]),
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("upper"),
        F.coalesce("count", F.lit(0).cast("long")).alias("count"),
    )


def histogram_by_flag(
    df: DataFrame,
    value: str = "close",
    flag: str = IQR_FLAG,
    bins: int = 80,
    extremes: DataFrame | None = None,
) -> DataFrame:
    """One histogram of the flagged rows and one of the others, each on its own range."""
    return histogram(df, F.col(value), bins, by=flag, extremes=extremes)


def histogram_log(
    df: DataFrame,
    value: str = "volume",
    edges: int = 80,
    digits: int | None = None,
    extremes: DataFrame | None = None,
) -> DataFrame:
    """Bins of equal width in log10, between ``edges`` edges, over positive values.

    ``digits`` rounds the logarithms, for a comparison with another engine's.
    """
    logs = F.log10(F.col(value))
    logs = logs if digits is None else F.round(logs, digits)
    return histogram(df.where(F.col(value) > 0), logs, edges - 1, extremes=extremes)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value``: one row per row and numeric column, as doubles."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([], list(columns), "column", "value")


def histogram_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10
) -> DataFrame:
    """A histogram of every numeric column."""
    columns = numeric_columns(df) if columns is None else columns
    return histogram(melt(df, columns), F.col("value"), bins, by="column")
