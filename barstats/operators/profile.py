"""Profiles of a table: gaps, copies, spread, correlation, shape of returns, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstats.functions import is_missing, ratio
from barstats.operators.histograms import melt, numeric_columns
from barstats.operators.quantiles import exact_quantiles
from barstats.schema import CORRELATION_FEATURES, TS


def schema_listing(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types, in order."""
    return df.dtypes


def null_counts(df: DataFrame) -> DataFrame:
    """``column, missing, rows``: one row per column."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(is_missing(df, n)).alias(f"_{i}") for i, n in enumerate(df.columns)],
    )
    lines = [
        F.struct(
            F.lit(n).alias("column"), F.col(f"_{i}").alias("missing"), F.col("_rows").alias("rows")
        )
        for i, n in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*lines)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one. Copies are counted map-side."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles per numeric column."""
    columns = numeric_columns(df) if columns is None else columns
    long = melt(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = long.groupBy("column").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quarters = exact_quantiles(
        long, "value", (0.25, 0.5, 0.75), by=["column"], interpolate=True, few_groups=True
    )
    # One row per column of the table on both sides.
    return moments.join(F.broadcast(quarters), "column").select(
        "column", "count", "mean", "std", "min",
        *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))],
        "max",
    )


def boxplot_stats(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (the outermost values within ``k`` IQRs) and outliers of a column."""
    quarters = exact_quantiles(df, column, (0.25, 0.5, 0.75), interpolate=True)
    box = quarters.select(
        F.struct(*[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q1", "q2", "q3"))])
    ).scalar()
    x = F.col(column).cast("double")
    boxed = df.select(x.alias("_x"), box.alias("_box")).where(
        F.col("_x").isNotNull() & ~F.isnan("_x")
    )
    reach = F.lit(float(k)) * (F.col("_box.q3") - F.col("_box.q1"))
    inside = F.col("_x").between(F.col("_box.q1") - reach, F.col("_box.q3") + reach)
    return boxed.agg(
        F.max("_box.q1").alias("q1"),
        F.max("_box.q2").alias("median"),
        F.max("_box.q3").alias("q3"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def time_range(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def correlation_matrix(
    df: DataFrame,
    columns: Sequence[str] = CORRELATION_FEATURES,
    means: DataFrame | None = None,
) -> DataFrame:
    """``a, b, corr`` for every ordered pair, over all rows that have both values.

    Pearson's r; NULL when either does not vary. Rows are grouped by which columns
    they have, so that within a group plain sums of products serve every pair; the
    groups are then added up per pair. Values are taken from their column's mean,
    which a first light pass finds, to keep the sums accurate; ``means`` (one row: m0, m1,
    and so on) saves it.
    """
    places = range(len(columns))
    pairs = [(i, j) for i in places for j in places if i <= j]
    # NaN is a gap, as NULL is: a pair that has one is left out.
    doubles = df.select(
        *[
            F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}")
            for i, c in enumerate(columns)
        ]
    )
    if means is None:
        means = doubles.agg(*[F.avg(f"v{i}").alias(f"m{i}") for i in places])

    # Expressions as text: Python would build hundreds of nodes one call at a time.
    shifted = doubles.withColumn("_m", means.select(F.struct("*")).scalar()).selectExpr(
        *[f"v{i} - _m.m{i} AS x{i}" for i in places],
        "+".join(f"IF(v{i} IS NULL, 0, {2**i})" for i in places) + " AS has",
    )
    sums = shifted.groupBy("has").agg(
        F.count("*").alias("n"),
        *[F.expr(f"sum(x{i}) AS s{i}") for i in places],
        *[F.expr(f"sum(x{i} * x{j}) AS p{i}_{j}") for i, j in pairs],
    )
    both = ", ".join(
        f"named_struct('i', {i}, 'j', {j}, 'n', n, 'x', s{i}, 'y', s{j},"
        f" 'xx', p{i}_{i}, 'yy', p{j}_{j}, 'xy', p{i}_{j})"
        for i, j in pairs
    )
    # At most one row per combination of columns that occurs.
    per_pair = (
        sums.selectExpr(f"inline(array({both}))")
        .groupBy("i", "j")
        .agg(
            *[
                F.sum(F.when(F.col("xy").isNotNull(), F.col(c))).alias(c)
                for c in ("n", "x", "y", "xx", "yy", "xy")
            ]
        )
    )

    def spread(squares: str, total: str) -> Column:
        """Variance; zero when only rounding is left of it."""
        square = F.col(squares) / F.col("n")
        variance = square - F.pow(F.col(total) / F.col("n"), 2)
        return F.when(variance > square * 1e-12, variance).otherwise(F.lit(0.0))

    together = F.col("xy") / F.col("n") - F.col("x") / F.col("n") * F.col("y") / F.col("n")
    r = ratio(together, F.sqrt(spread("xx", "x")) * F.sqrt(spread("yy", "y")))
    names = F.array(*[F.lit(c) for c in columns])
    ends = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    )
    return (
        per_pair.withColumn("corr", F.when(F.col("i") == F.col("j"), r / r).otherwise(r))
        .select(F.explode(ends).alias("end"), "corr")
        .select(
            F.get(names, F.col("end.i")).alias("a"), F.get(names, F.col("end.j")).alias("b"), "corr"
        )
    )


def return_distribution(df: DataFrame, column: str) -> DataFrame:
    """Moments of a column, with the Jarque-Bera statistic for normality."""
    x = F.col(column)
    moments = df.where(x.isNotNull() & ~F.isnan(x)).agg(
        F.count("*").alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.skewness(x).alias("skewness"),
        F.kurtosis(x).alias("excess_kurtosis"),
    )
    s, k = F.col("skewness"), F.col("excess_kurtosis")
    return moments.withColumn("jarque_bera", F.col("n") / 6 * (s * s + k * k / 4))


SAMPLE_CELL_DIGITS = 5


def sample_rows(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """The ``n`` rows whose key has the smallest MD5: the same rows on every run.

    Counting the rows per leading digits tells how far the sample reaches, so that
    only about that many rows are sorted, and not ``n`` rows of every task.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]))
    cell = F.substring("_digest", 1, SAMPLE_CELL_DIGITS)
    keyed = df.withColumn("_digest", digest)
    held = keyed.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_held"))
    climb = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16 ** SAMPLE_CELL_DIGITS cells, whatever the size of the table.
    last = (
        held.withColumn("_before", F.coalesce(F.sum("_held").over(climb), F.lit(0)))
        .where(F.col("_before") < n)
        .agg(F.max("_cell").alias("_last"))
        .scalar()
    )
    return keyed.where(cell <= last).orderBy("_digest", *key).limit(int(n)).drop("_digest")
