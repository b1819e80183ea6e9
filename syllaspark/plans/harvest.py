"""Harvests: each institution's strategy from course rows to extracted text."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import discovery, pdf
from ..functions.embedded import embedded_plan
from ..functions.html import extract_css
from ..functions.keys import academic_year
from ..functions.pdfread import read_pages
from ..functions.text import module_name, renumber_module, shadow_text
from ..operators.columns import ensure_output, validate, with_course_id, with_url
from ..operators.filters import of_institution, year_filter
from ..operators.joins import by_code, keep_first, lookup_url, match_discovery
from ..operators.reports import funnel
from ..operators.sets import bind_rows
from ..schema import CODE, RAW, SEASON, YEAR
from ..sources.fetch import Transport, fetch, fetch_with_checkpoint
from ..sources.tables import append, exists, read, remove, save_harvest
from .registry import INSTITUTIONS, Institution, institution

#: Pages that lead to a subject's document.
SUBJECTS = {
    "Norsk": "https://www.steinerhoyskolen.no/dokumenter/laerer-bachelor-norsk-1",
    "Matematikk": "https://www.steinerhoyskolen.no/dokumenter/laerer-bachelor-matematikk-1",
    "Naturfag": "https://www.steinerhoyskolen.no/dokumenter/laerer-bachelor-naturfag-1",
    "Pedagogikk og elevkunnskap": "https://www.steinerhoyskolen.no/dokumenter/laerer-bachelor-pedagogikk-og-elevkunnskap-1",
    "Samfunnsfag": "https://www.steinerhoyskolen.no/dokumenter/laerer-bachelor-samfunnsfag-1",
}
#: Pages that list a code's terms.
LISTING = {"hivolda": lambda code: F.concat(F.lit("https://www.hivolda.no/emne/"), code), "uit": lambda code: F.concat(F.lit("https://uit.no/utdanning/aktivt/emne/"), F.upper(code))}


@dataclass
class Harvester:
    """What a harvest needs from outside: a session, a checkpoint folder, a transport and readers.

    ``pdf_reader`` turns a document into page texts.  ``browser`` renders candidate
    pages of versioned courses: it takes courses and returns course_id, code, year,
    season, version and content.
    """

    spark: SparkSession
    folder: str
    transport: Transport
    pdf_reader: Callable[[bytes], list[str]] = read_pages
    browser: Callable[[DataFrame], DataFrame] | None = None
    refetch: bool = False
    retry_failed: bool = False
    errors: dict[str, str] = field(default_factory=dict)

    def checkpoint(self, config: Institution, kind: str) -> str:
        return f"{self.folder}/{kind}_{config.name}"

    def once(self, path: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A stored table; made first where it is missing or to be made afresh."""
        if self.refetch:
            remove(self.spark, path)
        if not exists(self.spark, path):
            append(make(), path)
        return read(self.spark, path)

    def pages(self, rows: DataFrame, config: Institution, kind: str = "html") -> DataFrame:
        return fetch_with_checkpoint(self.spark, rows, self.checkpoint(config, kind), self.transport, config.user_agent, self.refetch, self.retry_failed)

    def extracted(self, rows: DataFrame, config: Institution) -> DataFrame:
        return rows.withColumn("extracted_text", extract_css(F.col("html"), config.selector, config.mode, config.before, config.after))

    # --- strategies: rows with course_id and url in, output columns out ---

    def standard(self, rows: DataFrame, config: Institution) -> DataFrame:
        return self.extracted(self.pages(rows, config), config)

    def url_discovery(self, rows: DataFrame, config: Institution) -> DataFrame:
        """Addresses from the listing page of each code, fetched once per code."""
        listing = rows.select(CODE).distinct().select(F.col(CODE).alias("course_id"), CODE, LISTING[config.name](F.col(CODE)).alias("url"), F.lit(config.name).alias("institution_short"))
        found = self.once(self.checkpoint(config, "urls"), lambda: self._listed(listing, config))
        return self.standard(lookup_url(rows, found, [F.col("url")]), config)

    def _listed(self, listing: DataFrame, config: Institution) -> DataFrame:
        pages = self.pages(listing, config, "listing").select(CODE, "html")
        found = (discovery.discover_links if config.name == "hivolda" else discovery.discover_options)(pages)
        return keep_first(found, [CODE, YEAR, SEASON], [F.col("_at")]).drop("_at")

    def shadow_dom(self, rows: DataFrame, config: Institution) -> DataFrame:
        """Rendered text of the version that shows the wanted term; its number is kept."""
        if self.browser is None:
            raise ValueError("this strategy needs a browser")
        best = self.once(self.checkpoint(config, "urls"), lambda: discovery.probe_versions(self.browser(rows)))
        out = rows.drop("url").join(best, "course_id", "left").withColumn("url", F.when(F.col("version").isNotNull(), discovery.version_url()))
        out = out.withColumn("html_success", F.coalesce(F.length("html") > 0, F.lit(False))).withColumn("extracted_text", shadow_text(F.col("html")))
        return out.withColumnRenamed("version", "url_version")

    def html_pdf_discovery(self, rows: DataFrame, config: Institution) -> DataFrame:
        """Addresses by year from each course page's menu; pages and documents go separate ways."""
        base = keep_first(rows.where(F.col("url").isNotNull()).select(F.col(RAW), F.col(RAW).alias("course_id"), "url", "institution_short"), [RAW], [F.col("url")])
        menu = self.once(self.checkpoint(config, "discovery"), lambda: discovery.discover_menu(self.pages(base, config, "menu").select(RAW, "html")))
        matched = match_discovery(rows, menu)
        pages = self.standard(matched.where("route = 'html'"), config)
        documents = matched.where("route = 'pdf'")
        texts = self.once(self.checkpoint(config, "pdf"), lambda: self._documents(documents, config))
        return bind_rows(pages, documents.join(texts, "course_id", "left"), matched.where("route = 'none'")).drop("route", "url_type")

    def _documents(self, rows: DataFrame, config: Institution) -> DataFrame:
        once = keep_first(rows.select("course_id", "url"), ["course_id"], [F.col("url")])
        got = fetch(once, self.transport, agent=config.user_agent)
        return got.select("course_id", F.lit(None).cast("string").alias("html"), "html_error", "html_success", pdf.pdf_text(F.col("body"), self.pdf_reader).alias("extracted_text"))

    def pdf_split(self, rows: DataFrame, config: Institution) -> DataFrame:
        """Sections of each subject's document, joined by the module's name; the address is the subject page's."""
        parts = self.once(self.checkpoint(config, "pdf"), lambda: self._sections(config))
        parts = keep_first(parts.withColumn("join_key", renumber_module(module_name(F.col("pdf_emne_name")))), ["join_key"], [F.col("url"), F.col("pdf_emne_name")])
        return rows.drop("url").withColumn("join_key", module_name(F.col("Emnenavn"))).join(parts.select("join_key", "url", "extracted_text"), "join_key", "left").drop("join_key")

    def _sections(self, config: Institution) -> DataFrame:
        subjects = self.spark.createDataFrame([(s, u, u) for s, u in SUBJECTS.items()], "subject string, course_id string, url string")
        leads = fetch(subjects, self.transport, agent=config.user_agent).select("course_id", discovery.first_pdf(F.decode("body", "UTF-8")).alias("pdf"))
        named = subjects.join(leads, "course_id").where(F.col("pdf").isNotNull()).select("subject", F.col("url").alias("page"), F.col("subject").alias("course_id"), F.col("pdf").alias("url"))
        got = fetch(named, self.transport, agent=config.user_agent).select("course_id", pdf.pdf_pages(F.col("body"), self.pdf_reader).alias("pages"))
        return pdf.sections(named.join(got, "course_id").select("subject", F.col("page").alias("url"), "pages"))

    def json_extract(self, rows: DataFrame, config: Institution) -> DataFrame:
        """All years stand in one page per code: fetched once, handed to every row."""
        once = keep_first(rows.where(F.col("url").isNotNull()).select(CODE, "url", "institution_short"), [CODE], [F.col("url")])
        pages = self.pages(once.withColumn("course_id", F.concat(F.lit(f"{config.name}_"), CODE)), config).select(CODE, "html", "html_error", "html_success")
        return by_code(rows, pages).withColumn("extracted_text", embedded_plan(F.col("html"), academic_year(F.col(YEAR), F.col(SEASON))))

    def noop(self, rows: DataFrame, config: Institution) -> DataFrame:
        return rows.withColumn("url", F.lit(None).cast("string")).withColumn("extracted_text", F.lit(None).cast("string"))

    # --- whole harvests ---

    def prepare(self, courses: DataFrame, config: Institution, year: int | None = None) -> DataFrame:
        rows = year_filter(of_institution(courses, config.name), config.year_in_url, year)
        return validate(with_url(with_course_id(validate(rows, "initial"))), "with_url")

    def harvest(self, courses: DataFrame, name: str, year: int | None = None) -> DataFrame:
        config = institution(name)
        return ensure_output(getattr(self, config.strategy)(self.prepare(courses, config, year), config))

    def harvest_all(self, courses: DataFrame, out: str, year: int | None = None, names: list[str] | None = None, at_once: int = 4) -> dict[str, dict]:
        """Harvest institutions into a partitioned table; counts by institution.

        ``at_once`` of them fetch at the same time, each in jobs of its own; their rows are
        saved one after the other.  One that fails keeps its earlier rows, and its error
        is in ``errors``.
        """
        counts, names = {}, list(names or INSTITUTIONS)
        with ThreadPoolExecutor(max(1, at_once)) as pool:
            harvests = {name: pool.submit(self.harvest, courses, name, year) for name in names}
        for name in names:
            try:
                save_harvest(harvests[name].result(), out)
                counts[name] = funnel(read(self.spark, out).where(F.col("institution_short") == name)).first().asDict()
            except Exception as e:
                self.errors[name] = f"{type(e).__name__}: {e}"
        return counts
