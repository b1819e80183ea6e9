"""Plans embedded as JSON in a page's script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rx
from .html import html_texts

_ITEM = "array<struct<title:string,content:string>>"
_PROPS = f"struct<props:struct<items:map<string,struct<title:string,table:{_ITEM},accordions:{_ITEM}>>>>"


def _json_text(html: Column) -> Column:
    """From the first to the last brace of the first script that names the plan component."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script\s*>"), F.lit(1))
    own = F.element_at(F.filter(scripts, lambda s: s.contains("EmneplanPage")), 1)
    return rx.extract(own, r"(?s)(\{.*\})", 1)


def embedded_plan(html: Column, year: Column) -> Column:
    """The plan of an academic year: title, ``title: content`` lines, then titled sections, a blank line apart.

    Everything but the text of section contents, which is HTML, stays in the JVM.
    Null where the page, the script, the year or all parts are missing.
    """
    some = lambda c: F.length(c) > 0
    plan = F.try_element_at(F.from_json(_json_text(html), _PROPS)["props"]["items"], year)
    lines = F.transform(F.filter(plan["table"], lambda i: i["title"].isNotNull() & some(i["content"])), lambda i: F.concat(i["title"], F.lit(": "), i["content"]))
    sections = F.coalesce(plan["accordions"], F.array().cast(_ITEM))
    contents = html_texts(F.transform(sections, lambda i: i["content"]))
    titled = F.arrays_zip(F.transform(sections, lambda i: F.coalesce(i["title"], F.lit(""))).alias("title"), contents.alias("text"))
    joined = F.transform(titled, lambda i: F.array_join(F.filter(F.array(i["title"], i["text"]), some), "\n"))
    none = F.array().cast("array<string>")
    parts = F.concat(F.array(F.coalesce(plan["title"], F.lit(""))), F.coalesce(lines, none), joined)
    return F.when(plan.isNotNull(), rx.blank_to_null(F.array_join(F.filter(parts, some), "\n\n")))
