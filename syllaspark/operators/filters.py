"""Row filters of course tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_text
from ..schema import SEASON, YEAR


def present(url: Column) -> Column:
    return url.isNotNull() & (url != "")


def of_institution(courses: DataFrame, name: str) -> DataFrame:
    return courses.where(F.col("institution_short") == name)


def year_filter(courses: DataFrame, year_in_url: bool, year: int | None = None) -> DataFrame:
    """An explicit year; or, where addresses hold no year, the latest one alone; or everything.

    The latest year is one aggregated row, joined back, rather than a window over
    the whole table.
    """
    if year is not None:
        return courses.where(F.col(YEAR) == year)
    if year_in_url:
        return courses
    latest = courses.agg(F.max(YEAR).alias("_latest"))
    return courses.join(F.broadcast(latest), F.col(YEAR) == F.col("_latest"), "left_semi")


def latest_year(courses: DataFrame, by: str = "institution_short") -> DataFrame:
    """Rows of the latest year of each institution: partial maxima first, then a join with few rows."""
    latest = courses.groupBy(F.col(by).alias("_by")).agg(F.max(YEAR).alias("_latest"))
    return courses.join(latest, (F.col(by) == F.col("_by")) & (F.col(YEAR) == F.col("_latest")), "left_semi")


def latest_year_by_window(courses: DataFrame, by: str = "institution_short") -> DataFrame:
    """The same with a window, for tables already dealt out by institution."""
    return courses.withColumn("_latest", F.max(YEAR).over(Window.partitionBy(by))).where(F.col(YEAR) == F.col("_latest")).drop("_latest")


def browse(courses: DataFrame, institutions: Iterable[str] = (), years: tuple[int, int] | None = None, seasons: Iterable[str] = (), status: Iterable[int | str] = (), with_text: bool = False) -> DataFrame:
    """Rows that meet every given condition; an empty selection asks nothing."""
    out = courses
    if institutions := list(institutions):
        out = out.where(F.col("institution_short").isin(institutions))
    if years is not None:
        out = out.where(F.col(YEAR).between(*years))
    if seasons := list(seasons):
        out = out.where(F.col(SEASON).isin(seasons))
    if status := [int(s) for s in status]:
        out = out.where(F.col("Status").isin(status))
    return out.where(has_text(F.col("extracted_text"))) if with_text else out


def route(url: Column, kind: Column) -> Column:
    """How a discovered address is to be fetched: ``html``, ``pdf`` or ``none``."""
    return F.when(url.isNotNull() & kind.isin("html", "pdf"), kind).otherwise("none")


def known_since(courses: DataFrame, codes: DataFrame, code_col: str, first_year: int = 2015) -> DataFrame:
    """Rows from a year on whose code another table knows."""
    return courses.where(F.col(YEAR) >= first_year).join(codes.select(F.col(code_col).alias(code_col)).distinct(), code_col, "left_semi")


def page(rows: DataFrame, order: list[Column], number: int, size: int = 10) -> DataFrame:
    """One page of an ordered table; ``order`` should settle ties."""
    return rows.orderBy(*order).offset(number * size).limit(size)


def first_n(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)
