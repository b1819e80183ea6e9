"""Joins of course tables with checkpoints, lookups and discoveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CODE, RAW, SEASON, YEAR
from .filters import present, route


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by an explicit order.

    Expressed as the least (order, row) of each group, so that rows are reduced
    before they are shuffled.
    """
    names = rows.columns
    packed = F.struct(*[F.col(f"`{n}`") for n in names])
    order_by = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])
    first = rows.groupBy(*keys).agg(F.min_by(packed, order_by).alias("_row"))
    return first.select(*[F.col("_row").getField(n).alias(n) for n in names])


def todo(courses: DataFrame, checkpoint: DataFrame, key: str = "course_id") -> DataFrame:
    """Rows with an address that the checkpoint lacks, whether it holds success or failure."""
    return courses.where(present(F.col("url"))).join(checkpoint.select(key).distinct(), key, "left_anti")


def merge_checkpoint(courses: DataFrame, checkpoint: DataFrame, order: list[Column]) -> DataFrame:
    """Fetched columns for each course; of several results the first counts."""
    first = keep_first(checkpoint.select("course_id", "html", "html_error", "html_success", *[c for c in ("fetched_at",) if c in checkpoint.columns]), ["course_id"], order)
    return courses.drop("html", "html_error", "html_success").join(first.select("course_id", "html", "html_error", "html_success"), "course_id", "left")


def lookup_url(courses: DataFrame, lookup: DataFrame, order: list[Column]) -> DataFrame:
    """Discovered addresses by code, year and season; the first found counts."""
    keys = [CODE, YEAR, SEASON]
    first = keep_first(lookup.select(*keys, "url"), keys, order)
    return courses.drop("url").join(first, keys, "left")


def update_rows(rows: DataFrame, updates: DataFrame, key: str = "course_id") -> DataFrame:
    """Columns of ``updates`` overwrite those of matching rows, also with null; unmatched updates are ignored.

    Update keys must be unique, as a second update of a row would have no order.
    """
    own = [c for c in updates.columns if c != key and c in rows.columns]
    new = updates.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in own])
    joined = rows.join(new, key, "left")
    return joined.select(*[(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(f"`{c}`")).alias(c) if c in own else F.col(f"`{c}`")) for c in rows.columns])


def match_discovery(courses: DataFrame, discovery: DataFrame) -> DataFrame:
    """Addresses of a discovery by raw code and year, with how to fetch them.

    A discovery may list a year twice: then a page is preferred to a PDF, and the
    least address to others, so that rows don't multiply.  A row without a match
    keeps its own address and is marked, as that page may be of another year.
    """
    found = discovery.where(F.col("year").isNotNull()).select(F.col(RAW), F.col("year").alias(YEAR), F.col("url").alias("_url"), F.col("type").alias("_type"))
    found = keep_first(found, [RAW, YEAR], [F.col("_type") != "html", F.col("_url")])
    out = courses.join(found, [RAW, YEAR], "left")
    out = out.withColumn("url_matched", F.col("_type").isNotNull()).withColumn("url", F.coalesce("_url", "url")).withColumn("url_type", F.coalesce("_type", F.lit("html")))
    return out.drop("_url", "_type").withColumn("route", route(F.col("url"), F.col("url_type")))


def by_code(courses: DataFrame, pages: DataFrame, key: str = CODE) -> DataFrame:
    """One page for each code handed on to all of its rows."""
    return courses.join(pages, key, "left")


def fetch_once(courses: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row with an address for each key, so that nothing is fetched twice."""
    return keep_first(courses.where(F.col("url").isNotNull()).select(key, "url", "institution_short"), [key], order)

