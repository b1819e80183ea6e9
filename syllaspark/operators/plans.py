"""Plans by content: lookup, versions and consecutive pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import anonymize, normalize_plan, plan_id, same_text
from ..schema import CODE, RAW, SEASON, YEAR


def clean(courses: DataFrame) -> DataFrame:
    """``course_plan`` from ``extracted_text``: one narrow projection."""
    return courses.withColumn("course_plan", anonymize(F.col("institution_short"), F.col("extracted_text")))


def hashed(courses: DataFrame) -> DataFrame:
    """``course_plan_normalized`` and ``plan_content_id`` from ``course_plan``."""
    missing = [c for c in ("institution_short", CODE, YEAR, "course_plan") if c not in courses.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = courses.withColumn("course_plan_normalized", normalize_plan(F.col("course_plan")))
    return out.withColumn("plan_content_id", plan_id(F.col("course_plan_normalized")))


def plan_lookup(courses: DataFrame, tie: str = "course_id") -> DataFrame:
    """One row for each plan, institution and code: its years and the texts of its first row.

    First is the earliest year, ties by ``tie``.  Rows without a plan are left out after
    the aggregate, by a count: a filter before it would be pushed below the projection
    that hashes, and normalise each text once more.
    """
    first = F.struct(F.col(YEAR).alias("y"), F.col(tie).alias("t"))
    texts = F.struct("course_plan", "course_plan_normalized")
    out = courses.groupBy("plan_content_id", "institution_short", CODE).agg(F.min(YEAR).alias("year_from"), F.max(YEAR).alias("year_to"), F.min_by(texts, first).alias("_first"), F.count("plan_content_id").alias("_n"))
    return out.where("_n > 0").select("plan_content_id", "institution_short", CODE, "year_from", "year_to", "_first.course_plan", "_first.course_plan_normalized")


def deduplicate(courses: DataFrame, tie: str = "course_id") -> tuple[DataFrame, DataFrame]:
    """(plan lookup, courses with plan id)."""
    marked = hashed(courses)
    return plan_lookup(marked, tie), marked


def first_per_course(courses: DataFrame, tie: str) -> DataFrame:
    """One row for each course_id, the least status first."""
    by = Window.partitionBy("course_id").orderBy(F.col("Status").asc_nulls_last(), tie)
    return courses.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def multi_version_codes(courses: DataFrame) -> DataFrame:
    """Codes of which at least two plans are known."""
    return courses.groupBy("institution_short", RAW).agg(F.countDistinct("plan_content_id").alias("versions")).where("versions >= 2")


def plan_versions(courses: DataFrame, tie: str = "course_id") -> DataFrame:
    """The plans of each code in order of their years, with a label such as ``V2 (2019-2021)``."""
    order = F.struct(F.col(YEAR).alias("y"), F.col(SEASON).alias("s"), F.col(tie).alias("t"))
    out = courses.groupBy("institution_short", RAW, "plan_content_id").agg(
        F.min(YEAR).alias("year_from"),
        F.max(YEAR).alias("year_to"),
        F.count("plan_content_id").alias("semesters"),  # none where there is no plan; see plan_lookup
        *[F.min_by(c, order).alias(c) for c in ("extracted_text", "course_plan_normalized")],  # each alone, so that one that nothing reads isn't moved
    ).where("semesters > 0")
    number = F.row_number().over(Window.partitionBy("institution_short", RAW).orderBy("year_from", "year_to", "plan_content_id"))
    years = F.when(F.col("year_from") == F.col("year_to"), F.col("year_from").cast("string")).otherwise(F.concat_ws("-", F.col("year_from").cast("string"), F.col("year_to").cast("string")))
    out = out.withColumn("number", number).withColumn("label", F.concat(F.lit("V"), F.col("number").cast("string"), F.lit(" ("), years, F.lit(")")))
    return out.select("institution_short", RAW, "number", "label", "plan_content_id", F.substring("plan_content_id", 1, 8).alias("hash_short"), "year_from", "year_to", "semesters", "extracted_text", "course_plan_normalized")


def version_pairs(versions: DataFrame, text: str = "course_plan_normalized") -> DataFrame:
    """Each version with the one before it, newest first within a code."""
    by = Window.partitionBy("institution_short", RAW).orderBy("number")
    out = versions.withColumn("old_label", F.lag("label").over(by)).withColumn("old_text", F.lag(text).over(by)).where("number > 1")
    return out.select("institution_short", RAW, "number", "old_label", F.col("label").alias("new_label"), "old_text", F.col(text).alias("new_text"), same_text(F.col("old_text"), F.col(text)).alias("same")).orderBy("institution_short", RAW, F.desc("number"))
