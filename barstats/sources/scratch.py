"""Where a job may put tables of its own: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session may go without one."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{SETTING} must name a folder that every executor can reach")
    return f"{tempfile.gettempdir()}/barstats"


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's own tables in the shared folder."""
    return f"{shared_folder(spark)}/barstats-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nothing has been written to yet."""
    return f"{run_folder(spark)}/{label}-{uuid4().hex}"


def discard(spark: SparkSession) -> bool:
    """Delete all that this application has put into the shared folder; False if there is nothing.

    For the caller to say when: tables that were returned read from there until they
    are written elsewhere.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The table written out and read back, for one that several passes read.

    What follows reads only the columns it needs of it, and a lost executor does not
    cost the work behind it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
