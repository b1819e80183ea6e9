"""Course-shaped views over the generic test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import strip_version
from ..operators.columns import with_course_id
from ..operators.plans import hashed
from ..schema import CODE, RAW, SEASON, YEAR
from ..session import spread
from .registry import INSTITUTIONS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def courses(spark: SparkSession, folder: str, registry: bool = False) -> DataFrame:
    """Documents as courses: the language, or with ``registry`` a known name, as institution.

    Copies of a text get different years, so that they are equal only once normalised.
    """
    docs = table(spark, folder, "documents")
    names = list(INSTITUTIONS)
    institution = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("doc_id") % len(names) + 1).cast("int")) if registry else F.col("lang")
    raw = F.concat(F.lit("C"), (F.col("n_chars") % 7).cast("string"), F.lit("-1"))
    year = (2004 + F.col("doc_id") % 22).cast("int")
    text = F.concat(F.col("text"), F.lit("\nLearning outcomes autumn "), year.cast("string"), F.lit(" Opprettet "), year.cast("string"))
    rows = docs.select(
        "doc_id",
        institution.alias("institution_short"),
        raw.alias(RAW),
        strip_version(raw).alias(CODE),
        F.concat(F.lit("Course "), (F.col("doc_id") % 50).cast("string")).alias("Emnenavn"),
        year.alias(YEAR),
        F.when(F.col("doc_id") % 2 == 0, "Vår").otherwise("Høst").alias(SEASON),
        (1 + F.col("doc_id") % 4).cast("int").alias("Status"),
        text.alias("extracted_text"),
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("https://example.org/?a=1&d="), F.col("doc_id").cast("string"))).alias("url"),
        F.col("source").alias("Avdelingsnavn"),
    )
    return with_course_id(rows)


def planned(spark: SparkSession, folder: str) -> DataFrame:
    """Courses whose text counts as their plan, normalised and hashed."""
    return hashed(spread(courses(spark, folder)).withColumn("course_plan", F.col("extracted_text")))
