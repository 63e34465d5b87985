"""Checks on a bar table: ones that raise, and a report of all of them as rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from barstats.functions import is_missing
from barstats.schema import CHART_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS, RAW_SCHEMA


def absent_columns(df: DataFrame, required: Iterable[str] = RAW_COLUMNS) -> list[str]:
    have = set(df.columns)
    return [name for name in required if name not in have]


def non_numeric_columns(df: DataFrame, expected: Iterable[str] = NUMERIC_COLUMNS) -> list[str]:
    """Columns that should be numeric and are not; absent ones are not looked at."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [n for n in expected if n in types and not isinstance(types[n], NumericType)]


def validate_schema(df: DataFrame, expected: StructType = RAW_SCHEMA) -> None:
    """Names, order, types and nullability must all agree."""
    if df.schema != expected:
        raise ValueError(
            f"expected schema {expected.simpleString()}, found {df.schema.simpleString()}"
        )


def validate_required_columns(df: DataFrame, required: Iterable[str] | None = None) -> None:
    missing = absent_columns(df, RAW_COLUMNS if required is None else required)
    if missing:
        raise ValueError(f"required columns are absent: {missing} (present: {df.columns})")


def validate_chart_columns(df: DataFrame) -> None:
    """What the chart aggregates need of an enriched table."""
    validate_required_columns(df, CHART_COLUMNS)


def validate_not_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("the table has no rows")


def validate_numeric_columns(df: DataFrame) -> None:
    wrong = non_numeric_columns(df)
    if wrong:
        raise ValueError(f"columns that must be numeric are not: {wrong}")


def data_quality_report(df: DataFrame, expected: StructType = RAW_SCHEMA) -> DataFrame:
    """``check, passed, detail``: the four checks, then missing values per column.

    One pass over the table; what the schema alone decides is added as constants.
    """
    absent = absent_columns(df, expected.names)
    non_numeric = non_numeric_columns(df)
    watched = [n for n in expected.names if n in df.columns]
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(is_missing(df, n)).alias(f"_missing_{n}") for n in watched],
    )

    def line(check, passed, detail):
        return F.struct(
            F.lit(check).alias("check"), passed.alias("passed"), detail.alias("detail")
        )

    lines = [
        line("schema", F.lit(df.schema == expected), F.lit(df.schema.simpleString())),
        line("required_columns", F.lit(not absent), F.lit(",".join(absent))),
        line("not_empty", F.col("_rows") > 0, F.col("_rows").cast("string")),
        line("numeric_columns", F.lit(not non_numeric), F.lit(",".join(non_numeric))),
        *[
            line(f"missing:{n}", F.col(f"_missing_{n}") == 0,
                 F.col(f"_missing_{n}").cast("string"))
            for n in watched
        ],
    ]
    return counts.select(F.inline(F.array(*lines)))
