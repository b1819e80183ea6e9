"""Harvested rows that arrive as files, cleaned and added to the course table as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.joins import keep_first
from ..operators.plans import clean, hashed
from ..sources.tables import exists, read
from ..schema import YEAR


def follow(spark: SparkSession, folder: str, schema: StructType, out: str, state: str) -> StreamingQuery:
    """Append new courses below ``folder`` to the table at ``out``; a course that the table has is passed by.

    Each batch is written under its own number, so that a repeated batch replaces
    itself and no course is added twice.
    """

    def add(batch: DataFrame, number: int) -> None:
        new = keep_first(hashed(clean(batch)), ["course_id"], [F.col(YEAR), F.col("extracted_text")])
        if exists(spark, out):
            new = new.join(read(spark, out).where(F.col("batch") != number).select("course_id"), "course_id", "left_anti")
        new.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(add).option("checkpointLocation", state).trigger(availableNow=True).start()


