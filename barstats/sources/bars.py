"""Reading bar tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from barstats.schema import RAW_SCHEMA


def _existing(load, path: str) -> DataFrame:
    """Spark looks the path up when the table is declared, on whatever file system it is."""
    try:
        return load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"nothing to read at {path}") from problem
        raise


def read_ohlcv_csv(
    path: str,
    spark: SparkSession | None = None,
    *,
    schema: StructType = RAW_SCHEMA,
    check_header: bool = True,
) -> DataFrame:
    """A CSV file, folder or glob of bars, against a declared schema.

    A malformed row fails the query. With ``check_header`` so does a header whose
    names are not the schema's; without it columns are matched by position only.
    """
    spark = spark or SparkSession.active()
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", not check_header)
    )
    return _existing(reader.csv, str(path))


def explore_csv(path: str, spark: SparkSession | None = None) -> DataFrame:
    """A CSV of unknown shape with inferred types: an extra pass, for looking around only."""
    spark = spark or SparkSession.active()
    reader = spark.read.option("header", True).option("inferSchema", True)
    return _existing(reader.csv, str(path))


def read_enriched(path: str, spark: SparkSession | None = None) -> DataFrame:
    """An enriched table, whole or by trading day."""
    spark = spark or SparkSession.active()
    return _existing(spark.read.parquet, str(path))
