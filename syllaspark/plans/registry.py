"""The institutions: how each one's plans are found, fetched and read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..functions.text import break_cells, cut_render_error, cut_timetable


@dataclass(frozen=True)
class Institution:
    name: str
    code: str
    strategy: str = "standard"
    selector: str | None = None
    mode: str = "single"
    year_in_url: bool = True
    before: Callable[[Column], Column] | None = None  # on the page
    after: Callable[[Column], Column] | None = None  # on the text
    user_agent: str = "project"


#: Strategies, selectors and institution codes.
INSTITUTIONS = {
    i.name: i
    for i in (
        Institution("oslomet", "1175", selector="#main-content"),
        Institution("uia", "1171", selector="#right-main"),
        Institution("ntnu", "1150", selector="#content", after=cut_timetable),
        Institution("inn", "0264", selector=".content-inner", before=break_cells),
        Institution("hivolda", "0236", "url_discovery", "article.content-emweb", before=break_cells),
        Institution("hiof", "0256", selector="#vrtx-fs-emne-content, main .entry-content, .entry-content", user_agent="browser"),
        Institution("hvl", "0238", selector=".l-2-col__main-content"),
        Institution("mf", "8221", selector="main", year_in_url=False),
        Institution("nla", "8223", "json_extract", year_in_url=False),
        Institution("nord", "1174", selector=", ".join([*[f"#ac-trigger-{k}" for k in range(9)], ".ac-panel--inner", "#ac-panel-2 .field__item", "#ac-panel-0 li", "p", ".placeholder-text"]), mode="multi"),
        Institution("nih", "1260", selector=".fs-body"),
        Institution("uib", "1120", selector=".accordion, .accordion__main, .vertical-reset-children .vertical-reset-children div, summary, #main-content li, p, .vertical-reset-children .vertical-reset-children .mt-12", mode="multi"),
        Institution("uio", "1110", selector="#vrtx-course-content", year_in_url=False),
        Institution("uis", "1160", "html_pdf_discovery", "#block-page-content .link--, #block-page-content .paragraph--with-title", "multi"),
        Institution("usn", "1176", "shadow_dom"),
        Institution("uit", "1130", "url_discovery", ".hovedfelt > main > div.col-md-12", "multi", after=cut_render_error),
        Institution("nmbu", "1173", selector=".layout", year_in_url=False),
        Institution("samas", "0217", "noop", year_in_url=False),
        Institution("steiner", "8225", "pdf_split", year_in_url=False),
    )
}


def institution(name: str) -> Institution:
    if name not in INSTITUTIONS:
        raise ValueError(f"unknown institution: {name}")
    return INSTITUTIONS[name]


def dimension(spark: SparkSession) -> DataFrame:
    """The scalar settings as a table of one row per institution."""
    rows = [(i.name, i.code, i.strategy, i.selector, i.mode, i.year_in_url, i.user_agent) for i in INSTITUTIONS.values()]
    return spark.createDataFrame(rows, "institution_short string, code string, strategy string, selector string, mode string, year_in_url boolean, user_agent string")
