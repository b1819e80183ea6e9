"""Texts and sections of PDF documents."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rx
from .text import page_texts, tidy_lines


def pdf_pages(raw: Column, reader: Callable[[bytes], list[str]]) -> Column:
    """Page texts by a pluggable reader; an unreadable document gives null."""

    def run(column: pd.Series) -> pd.Series:
        def one(data):
            try:
                return list(reader(data)) if data else None
            except Exception:
                return None

        return column.map(one, na_action=None)

    return F.pandas_udf(run, "array<string>")(raw)


def pdf_text(raw: Column, reader: Callable[[bytes], list[str]]) -> Column:
    return page_texts(pdf_pages(raw, reader))


def sections(documents: DataFrame) -> DataFrame:
    """(subject, url, pdf_emne_name, extracted_text) from ``documents`` of subject, url and pages.

    A section begins at a page whose first line is ``<subject> N, emne M`` and ends
    before the next such page or overview (``emne M-N``).  The pages of one document
    are an array, so the cut is a fold over it and nothing is shuffled.
    """
    head = lambda p: F.element_at(F.split(p, "\n"), 1)
    subject = F.regexp_replace(F.col("subject"), r"\s+", r"\\\\s+")
    start = lambda p: F.regexp_like(head(p), F.concat(F.lit(r"(?iU)^\s*"), subject, F.lit(r"\s+\d+\s*,\s*emne\s+\d+")))
    overview = lambda p: F.regexp_like(head(p), F.lit(r"(?iU)emne\s+\d+\s*-\s*\d+"))
    marks = F.transform("pages", lambda p, i: F.struct(i.alias("i"), (start(p) & ~overview(p)).alias("own"), (start(p) | overview(p)).alias("any")))
    rows = documents.where(F.col("pages").isNotNull()).withColumn("marks", marks)
    begin = F.transform(F.filter("marks", lambda m: m["own"]), lambda m: m["i"])
    rows = rows.select("subject", "url", "pages", "marks", F.explode(begin).alias("first"))
    after = F.array_min(F.transform(F.filter("marks", lambda m: m["any"] & (m["i"] > F.col("first"))), lambda m: m["i"]))
    own = F.slice("pages", F.col("first") + 1, F.coalesce(after, F.size("pages")) - F.col("first"))
    text = tidy_lines(F.array_join(own, "\n\n"), r"Side\s+\d+\s+av\s+\d+")
    return rows.select("subject", "url", rx.trim(head(F.element_at("pages", F.col("first") + 1))).alias("pdf_emne_name"), text.alias("extracted_text"))


def cache_name(subject: Column) -> Column:
    """A safe file name for a subject's document."""
    return F.lower(F.regexp_replace(F.regexp_replace(subject, r"\s+", "_"), r"[^A-Za-z0-9_-]", ""))
