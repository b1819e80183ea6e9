"""Parquet tables of courses: reading, appending and replacing partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import YEAR


#: Tasks, and so files, of one partition of a harvest at most.
SHARES = 8


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _path(spark, path)
    return store.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, store = _path(spark, path)
    store.delete(at, True)


def read(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """One table from several folders whose columns may differ; missing ones are null."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(*paths)


def read_light(spark: SparkSession, path: str) -> DataFrame:
    """Without the page bodies, which then aren't read from disk."""
    return read(spark, path).drop("html", "html_error")


def append(rows: DataFrame, path: str) -> None:
    """New rows of a checkpoint; earlier ones aren't rewritten."""
    rows.write.mode("append").parquet(path)


def save_harvest(rows: DataFrame, path: str) -> None:
    """Replace the partitions that ``rows`` hold, by institution and year; others stay.

    A harvest of one year thus leaves the other years of its institution alone.  Each
    partition is written by up to ``SHARES`` tasks, as one may hold a third of all rows.
    """
    share = F.pmod(F.xxhash64("course_id"), F.lit(SHARES))
    rows.repartition("institution_short", YEAR, share).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("institution_short", YEAR).parquet(path)


def course_html(spark: SparkSession, path: str, institution: str, course_id: str) -> DataFrame:
    """One course's page: its partition and two columns are read."""
    return read(spark, path).where((F.col("institution_short") == institution) & (F.col("course_id") == course_id)).select("html")
