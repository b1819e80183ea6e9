"""From harvested texts to plans, and what readers ask of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.diff import diff
from ..operators.columns import browse_columns, display
from ..operators.filters import browse, page
from ..operators.plans import clean, hashed, multi_version_codes, plan_lookup, plan_versions, version_pairs
from ..schema import RAW, SEASON, YEAR
from ..sources.tables import read


def build(spark: SparkSession, harvest_path: str, courses_path: str, plans_path: str) -> tuple[DataFrame, DataFrame]:
    """Clean, hash and group all harvested rows; write and return (plans, courses).

    The marked courses are written first and read back, as both outputs need them.
    """
    hashed(clean(read(spark, harvest_path))).write.mode("overwrite").partitionBy("institution_short").parquet(courses_path)
    courses = read(spark, courses_path)
    plan_lookup(courses).write.mode("overwrite").parquet(plans_path)
    return read(spark, plans_path), courses


def course_list(courses: DataFrame, number: int = 0, **conditions) -> DataFrame:
    """A page of the filtered course list as readers see it."""
    rows = browse(browse_columns(courses), **conditions)
    return display(page(rows, [F.col("institution_short"), F.col(RAW), F.col(YEAR), F.col(SEASON), F.col("course_id")], number))


def codes_with_versions(courses: DataFrame, institution: str) -> DataFrame:
    return multi_version_codes(courses.where(F.col("institution_short") == institution)).select(RAW).orderBy(RAW)


def version_diffs(courses: DataFrame, institution: str, code: str, normalized: bool = True, context: int = 3) -> DataFrame:
    """Differences between each two consecutive versions of a course, newest first."""
    own = courses.where((F.col("institution_short") == institution) & (F.col(RAW) == code))
    pairs = version_pairs(plan_versions(own), "course_plan_normalized" if normalized else "extracted_text")
    return pairs.withColumn("changes", diff(F.col("old_text"), F.col("new_text"), context))
