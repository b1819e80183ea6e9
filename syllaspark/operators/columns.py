"""Schema checks, projections and derived columns of course tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import course_id, course_url, or_na
from ..schema import CODE, HARVESTED, RAW, SEASON, YEAR

#: Columns that each stage needs.
REQUIRED = {
    "initial": ("institution_short", CODE, YEAR),
    "with_url": ("institution_short", "course_id", "url"),
    "with_html": ("institution_short", "course_id", "url", "html", "html_success"),
}
#: Names that users see.
STATUS = {0: "Unknown", 1: "Active", 2: "New", 3: "Discontinued", 4: "Disc. w/ exam"}
INSTITUTION = {
    "hiof": "HiOF", "hivolda": "Hivolda", "hvl": "HVL", "inn": "INN", "mf": "MF", "nih": "NIH", "nla": "NLA",
    "nmbu": "NMBU", "nord": "Nord", "ntnu": "NTNU", "oslomet": "OsloMet", "samas": "Samas", "steiner": "Steiner",
    "uia": "UiA", "uib": "UiB", "uio": "UiO", "uis": "UiS", "uit": "UiT", "usn": "USN",
}
#: Columns of the course browser.
BROWSE = ("course_id", "institution_short", RAW, "Emnenavn", YEAR, SEASON, "Status", "extracted_text", "url", "course_plan", "plan_content_id")
#: Old names of columns.
RENAMED = {"fulltext": "extracted_text", "fulltext_normalized": "course_plan_normalized"}


def validate(courses: DataFrame, stage: str = "initial") -> DataFrame:
    """The table itself; ValueError names the columns that it lacks for a stage."""
    if stage not in REQUIRED:
        raise ValueError(f"unknown stage: {stage}")
    missing = [c for c in REQUIRED[stage] if c not in courses.columns]
    if missing:
        raise ValueError(f"missing columns at {stage} stage: {', '.join(missing)}")
    return courses


def ensure_output(courses: DataFrame) -> DataFrame:
    """With every column of a harvest; those it lacked are null."""
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in HARVESTED.fields if f.name not in courses.columns}
    return courses.withColumns(lacking) if lacking else courses


def with_course_id(courses: DataFrame) -> DataFrame:
    """``course_id`` as the first column."""
    return courses.select(course_id().alias("course_id"), *[c for c in map(_quoted, courses.columns) if c != "`course_id`"])


def with_url(courses: DataFrame) -> DataFrame:
    return courses.withColumn("url", course_url("Avdelingsnavn" in courses.columns))


def _quoted(name: str) -> str:
    return f"`{name}`"


def labels(column: Column, names: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), column)


def escape_html(text: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def browse_columns(courses: DataFrame) -> DataFrame:
    return courses.select(*[_quoted(c) for c in BROWSE if c in courses.columns])


def display(courses: DataFrame) -> DataFrame:
    """What a reader of the course list sees."""
    link = F.concat(F.lit('<a href="'), escape_html(F.col("url")), F.lit('" target="_blank" title="'), escape_html(F.col("url")), F.lit('">Link</a>'))
    return courses.select(
        labels(F.col("institution_short"), INSTITUTION).alias("Institution"),
        F.col(RAW).alias("Code"),
        F.col("Emnenavn").alias("Name"),
        F.col(YEAR).alias("Year"),
        F.col(SEASON).alias("Semester"),
        labels(F.col("Status"), STATUS).alias("Status"),
        F.when(F.length("extracted_text") > 0, "Yes").otherwise("No").alias("Text"),
        F.coalesce(link, F.lit("")).alias("URL"),
    )


def rename_old(courses: DataFrame) -> DataFrame:
    """Old column names brought up to date; a table without them is unchanged."""
    return courses.withColumnsRenamed(RENAMED)


def institution_of(table: DataFrame, dimension: DataFrame, code_col: str = "Institusjonskode") -> DataFrame:
    """``institution_short`` from the registry's code; unknown codes give null.  The dimension has a row per institution."""
    names = dimension.select(F.col("code").alias("_code"), "institution_short")
    return table.join(F.broadcast(names), table[code_col] == F.col("_code"), "left").drop("_code")


__all__ = ["validate", "ensure_output", "with_course_id", "with_url", "display", "browse_columns", "rename_old", "institution_of", "labels", "or_na"]
