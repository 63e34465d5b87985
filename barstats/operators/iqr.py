"""Flags from the interquartile range (Tukey's fences)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstats.functions import iqr_flag_name
from barstats.operators.quantiles import exact_quantiles
from barstats.schema import IQR_K, RELATIVE_ERROR

QUARTILES = (0.25, 0.75)


def quartiles(
    df: DataFrame, column: str, relative_error: float, by: Sequence[str] = ()
) -> DataFrame:
    """``by``, ``q1``, ``q3``. Exact for an error of 0, else from a sketch that bounded."""
    if not 0 <= relative_error <= 1:
        raise ValueError(f"relative_error must be between 0 and 1, got {relative_error}")
    if relative_error == 0:
        found = exact_quantiles(df, column, QUARTILES, by=by)
    else:
        held = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
        sketch = F.percentile_approx(
            F.col(column).cast("double"), QUARTILES, math.ceil(1 / relative_error)
        )
        found = held.groupBy(*by).agg(sketch.alias("quantiles"))
    return found.select(
        *by, F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("q3")
    )


def iqr_bounds(
    df: DataFrame,
    column: str,
    k: float = IQR_K,
    relative_error: float = RELATIVE_ERROR,
    by: Sequence[str] = (),
) -> DataFrame:
    """``by``, ``lower``, ``upper``, not yet computed: one row, or one per group."""
    reach = F.lit(float(k)) * (F.col("q3") - F.col("q1"))
    return quartiles(df, column, relative_error, by).select(
        *by, (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")
    )


def compute_iqr_bounds(
    df: DataFrame, column: str, k: float = IQR_K, relative_error: float = RELATIVE_ERROR
) -> tuple[float, float]:
    """The two fences as numbers, for a caller who wants to see them. Runs a job."""
    row = iqr_bounds(df, column, k, relative_error).first()
    if row is None or row["lower"] is None:
        raise ValueError(f"no values in {column}")
    return row["lower"], row["upper"]


def outside(column: str, lower: Column, upper: Column) -> Column:
    return (F.col(column) < lower) | (F.col(column) > upper)


def add_iqr_anomaly_flag(
    df: DataFrame, column: str, lower: float | Column, upper: float | Column
) -> DataFrame:
    """TRUE strictly outside the fences, which may be numbers or columns."""
    fences = [f if isinstance(f, Column) else F.lit(float(f)) for f in (lower, upper)]
    return df.withColumns({iqr_flag_name(column): outside(column, *fences)})


def detect_iqr_anomalies(
    df: DataFrame,
    column: str,
    k: float = IQR_K,
    relative_error: float = RELATIVE_ERROR,
    *,
    source: DataFrame | None = None,
) -> DataFrame:
    """Flag against fences pooled over the whole table, in one lazy plan.

    ``source`` is the table to take the fences from, when a cheaper one than
    ``df`` holds the same values (the table ``df`` was derived from, say).
    """
    bounds = iqr_bounds(df if source is None else source, column, k, relative_error)
    fences = bounds.select(F.struct("lower", "upper").alias("fences")).scalar()
    marked = df.withColumn("_fences", fences)
    return add_iqr_anomaly_flag(
        marked, column, F.col("_fences.lower"), F.col("_fences.upper")
    ).drop("_fences")


def detect_iqr_anomalies_by(
    df: DataFrame,
    column: str,
    by: Sequence[str],
    k: float = IQR_K,
    relative_error: float = RELATIVE_ERROR,
    *,
    source: DataFrame | None = None,
) -> DataFrame:
    """Flag against fences of the row's own group.

    The join carries no hint: how many groups there are is up to the data, so
    Spark decides by the measured size whether to broadcast the fences.
    """
    bounds = iqr_bounds(df if source is None else source, column, k, relative_error, by)
    fences = bounds.select(
        *by, F.col("lower").alias("_lower"), F.col("upper").alias("_upper")
    )
    joined = df.join(fences, list(by), "left")
    flags = add_iqr_anomaly_flag(joined, column, F.col("_lower"), F.col("_upper"))
    return flags.select(*df.columns, iqr_flag_name(column))
