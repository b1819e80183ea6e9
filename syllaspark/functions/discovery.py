"""Addresses that pages list: links, menus and embedded documents."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CODE, RAW, SEASON, YEAR
from . import rx
from .html import Selector, parse, text_of
from .keys import leading_year, link_term, option_term

#: Fixed values.
HIVOLDA, UIT, UIS = "https://www.hivolda.no", "https://uit.no", "https://www.uis.no"

_ENTRY = "array<struct<text:string,href:string>>"


def _entries(selector: str, attribute: str):
    chosen = Selector(selector)

    def run(pages: pd.Series) -> pd.Series:
        def one(page):
            try:
                return [{"text": text_of(n), "href": n.attrs[attribute]} for n in chosen.all(parse(page)) if attribute in n.attrs] if page else []
            except Exception:
                return []

        return pages.map(one)

    return F.pandas_udf(run, _ENTRY)


def links(html: Column) -> Column:
    """Texts and targets of a page's links."""
    return _entries("a", "href")(html)


def options(html: Column) -> Column:
    """Texts and values of a page's menu entries."""
    return _entries("option", "value")(html)


def discover_links(pages: DataFrame) -> DataFrame:
    """(code, year, season, url) from listing pages: links to ``/emne/<code>/<number>`` whose text names a term.

    ``pages`` has the code and its listing page as ``html``.
    """
    rows = pages.select(CODE, F.posexplode(links(F.col("html"))).alias("_at", "_link"))
    tail = F.element_at(F.split(F.col("_link.href"), F.concat(F.lit("/emne/\\Q"), F.col(CODE), F.lit("\\E/"))), -1)
    rows = rows.where(F.col("_link.href").contains(F.concat(F.lit("/emne/"), F.col(CODE), F.lit("/"))) & tail.rlike(r"^\d"))
    year, season = link_term(F.col("_link.text"))
    return rows.select(CODE, year.alias(YEAR), season.alias(SEASON), F.concat(F.lit(HIVOLDA), "_link.href").alias("url"), "_at").where(F.col(YEAR).isNotNull())


def discover_options(pages: DataFrame) -> DataFrame:
    """(code, year, season, url) from menus whose entries carry a document id."""
    rows = pages.select(CODE, F.posexplode(options(F.col("html"))).alias("_at", "_option")).where(F.col("_option.href").contains("p_document_id"))
    year, season = option_term(F.col("_option.text"))
    return rows.select(CODE, year.alias(YEAR), season.alias(SEASON), F.concat(F.lit(UIT), "_option.href").alias("url"), "_at").where(F.col(YEAR).isNotNull())


def discover_menu(pages: DataFrame) -> DataFrame:
    """(label, url, type, year, raw code) from the semester menu of a course page and the older terms it carries.

    Absolute addresses are PDFs and relative ones pages; older terms are always PDFs.
    """
    pick, entry = Selector("select#fs-semester-select"), Selector("option")

    def run(column: pd.Series) -> pd.Series:
        def one(page):
            try:
                menu = pick.first(parse(page)) if page else None
                if menu is None:
                    return []
                out = [{"label": n.raw_text().strip(), "href": n.attrs.get("value"), "older": False} for n in entry.all(menu)]
                if not out:
                    return []
                older = menu.attrs.get("data-older") or "[]"
                return out + [{"label": x.get("label"), "href": x.get("url"), "older": True} for x in json.loads(older)]
            except Exception:
                return []

        return column.map(one)

    rows = pages.select(RAW, F.explode(F.pandas_udf(run, "array<struct<label:string,href:string,older:boolean>>")(F.col("html"))).alias("e"))
    kind = F.when(F.col("e.older") | F.coalesce(F.col("e.href").rlike("^https?://"), F.lit(False)), "pdf").otherwise("html")
    url = F.when(kind == "html", F.concat(F.lit(UIS), "e.href")).otherwise(F.col("e.href"))
    return rows.select(F.col("e.label").alias("label"), url.alias("url"), kind.alias("type"), leading_year(F.col("e.label")).alias("year"), RAW)


def first_pdf(html: Column) -> Column:
    """The first PDF that a page names, in its text before its embedded documents."""
    embedded = Selector("iframe, embed, object")

    def run(pages: pd.Series) -> pd.Series:
        def one(page):
            try:
                root = parse(page) if page else None
            except Exception:
                root = None
            if root is None:
                return None
            found = re.findall(r"https?://[^\"'\s]+\.pdf[^\"'\s]*", root.raw_text())
            found += [n.attrs["src"] for n in embedded.all(root) if ".pdf" in n.attrs.get("src", "")]
            return found[0] if found else None

        return pages.map(one)

    return F.pandas_udf(run, "string")(html)


def probe_versions(candidates: DataFrame) -> DataFrame:
    """For each course the version whose page shows the wanted term, from pages of versions 1, 2, ...

    ``candidates``: course_id, code, year, season, version, content.  A page without
    the course's code ends the series, and so does a first version that starts later
    than wanted; a page without a term is passed over.  Courses without a match give
    null.  A struct aggregate does this without a loop over versions.
    """
    shown_season = F.lower(rx.extract(F.col("content"), r"(?i)Undervisningsstart\s+(høst|vår)\s+(\d{4})", 1))
    shown_year = rx.extract(F.col("content"), r"(?i)Undervisningsstart\s+(høst|vår)\s+(\d{4})", 2).try_cast("int")
    rows = candidates.withColumn("_absent", F.col("content").isNotNull() & ~F.col("content").contains(F.col(CODE)))
    rows = rows.withColumn("_hit", F.coalesce(~F.col("_absent") & (shown_year == F.col(YEAR)) & (shown_season == F.lower(SEASON)), F.lit(False)))
    late = F.coalesce((F.col("version") == 1) & (shown_year > F.col(YEAR)), F.lit(False))
    rows = rows.withColumn("_stop", F.col("_absent") | late)
    first = rows.groupBy("course_id").agg(
        F.min(F.when(F.col("_stop"), F.col("version"))).alias("_end"),
        F.min(F.when(F.col("_hit"), F.struct("version", "content"))).alias("_best"),
    )
    ok = F.col("_best").isNotNull() & (F.col("_end").isNull() | (F.col("_best.version") < F.col("_end")))
    return first.select("course_id", F.when(ok, F.col("_best.version")).alias("version"), F.when(ok, F.col("_best.content")).alias("html"))


def version_url(base: str = "https://www.usn.no/studier/studie-og-emneplaner/") -> Column:
    """The address of a version's page."""
    return F.format_string(base + "#/emne/%s_%d_%d_%s", F.col(CODE), F.col("version"), F.col(YEAR), F.upper(F.col(SEASON)))
