"""Parquet sinks and the staging of intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), **options: str) -> str:
    """Overwrite a Parquet table and return its path; ``options`` are those of the writer."""
    df.write.mode("overwrite").options(**options).partitionBy(*partition_by).parquet(path)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A folder of this machine is taken only by a session that runs on this machine
    alone and has none set, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path below the application's own part of the shared folder."""
    return f"{_own_part(spark)}/{label}-{uuid.uuid4().hex}"


def _own_part(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tallyloom-{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Remove all tables this application has staged, once nobody reads them any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_own_part(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside when it is left; results are read inside."""
    try:
        yield
    finally:
        clear_staged(spark)


def stage(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write a table to the shared folder once and read it back.

    Later steps then scan only the columns they need, and a lost executor costs a
    re-read and not a recomputation of the steps before. ``clear_staged`` and
    ``staged_tables`` remove them again.
    """
    spark = df.sparkSession
    path = write_table(df, staging_path(spark, label), **options)
    return spark.read.schema(df.schema).parquet(path)
