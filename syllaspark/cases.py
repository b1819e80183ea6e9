"""Queries over inline rows whose results are known: rules and pages case by case.

Each query's SQL states the expected rows, so that a rule which no text of a table
happens to meet is still compared.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import discovery, text
from .functions.diff import diff, unified
from .functions.html import extract_css, page_facts
from .operators import filters, joins
from .schema import CODE, SEASON, YEAR


def values(names: str, rows: list[tuple], types: str = "") -> str:
    """SQL that gives the rows; strings with line feeds and quotes as they are."""

    def one(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "true" if x else "false"
        if isinstance(x, int):
            return str(x)
        return "'" + x.replace("'", "''") + "'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) AS t({names})"


#: Institution, text, what cleaning leaves.
CLEANED = [
    # rules for every institution
    ("other", "Spørsmål sendes til per-olav.aas+emne@skole.example.no innen fristen", "Spørsmål sendes til  innen fristen"),
    ("other", "Emnet ble opprettet 2017 og revidert 2019", "Emnet ble opprettet og revidert"),
    ("other", "Gjelder NOU 2019:23, 500 sider fra 1814 og 1990-årene", "Gjelder NOU 2019:23, 500 sider fra 1814 og 1990-årene"),
    ("other", "Lest 3. mar. 2021 07:45:10 av roboten", "Lest  av roboten"),
    ("other", "Møt klokka 13:30, slutt 15:00:00.", "Møt klokka , slutt ."),
    ("other", "Tema\nSist hentet fra FS (Felles studentsystem) 1. des. 2020 10:00\nMål", "Tema\n\nMål"),
    ("other", "Starter haust 2022 eller 2023 spring", "Starter  eller"),
    ("other", "Starter autumn24", "Starter"),
    ("other", "Semester: vår", "Semester:"),
    ("other", "Oppstart haust", "Oppstart"),
    ("other", "Vår felles arv om høsten", "Vår felles arv om høsten"),
    ("other", "Frist 1.2.2024 for opptak 2024/2025", "Frist  for opptak"),
    ("other", "Ring +47 99 88 77 66 nå", "Ring nå"),
    ("other", "Telefon: 12 34 56 78", None),
    ("other", "Før function (a, b) { b = a } etter $('#x').hide(1); slutt", "Før  etter  slutt"),
    ("other", "En  \n\n\n\nTo\t\n", "En\n\nTo"),
    ("other", "", None),
    ("other", None, None),
    # rules of single institutions
    ("ntnu", "Mål og mening\nKontaktinformasjon\nInstitutt for prøver\nRom 7", "Mål og mening"),
    ("ntnu", "course-details-portlet Prøveemne", "Prøveemne"),
    ("ntnu", "moment.locale('nb'); Velg studieår Studieår 2020/2021 Nivå", "Nivå"),
    ("ntnu", "Undervisningsstart uke 34\nAlt om eksamen ved NTNU Form", "Form"),
    ("ntnu", "Tema Blackboard - X1 Andre sider om emnet slutt", "Tema  slutt"),
    ("uit", "Startsida\nEmnekatalog\nFiske", "Fiske"),
    ("uit", "Se timeplan Error rendering component Havbruk", "Havbruk"),
    ("uit", "Mål\nKontaktperson\nLise Prøve\nForeleser:\nJon Prøve\nLitteratur", "Mål\n\nLitteratur"),
    ("uia", "Forside > Studier > Emner > 2019 > Vår 2019 > Musikk (Vår 2019) 10 poeng", "Musikk  10 poeng"),
    ("uia", "Mål\nEmneansvarlig:\nAda Prøve\nForm", "Mål\n\nForm"),
    ("hiof", "Mål\nLitteraturlista er sist oppdatert i går\nSist hentet fra FS\nForm", "Mål\n\nForm"),
    ("hiof", "Sted:\nHalden\nEmneansvarlig:\nAda Prøve\nBo Prøve\nSpråk:\nNorsk", "Sted:\nHalden\nSpråk:\nNorsk"),
    ("hiof", "FerdigheterKandidaten kan", "Ferdigheter Kandidaten kan"),
    ("inn", "NameCreditsDateComment\nName\nCredits\nDate\nComment\nInnhold", "Innhold"),
    ("inn", "Undervises på Engelsk", "Undervises på English"),
    ("inn", "Emnesøket gjelder kun fra 2030", None),
    ("oslomet", "Del en\n;\nDel to; del tre", "Del en\n\nDel to; del tre"),
    ("oslomet", "Form\nEmneansvarlig\nBo Prøve\nMål", "Form\n\nMål"),
    ("oslomet", "Siden du leter etter finnes ikke", None),
    ("mf", "Mål Vis flere Kontakt studieveileder Form\nEmneansvarlig\nBo Prøve\nAlt annet", "Mål Form"),
    ("hivolda", "Mål\nEmneansvarleg:\nBo Prøve\nGodkjent av:\nAda Prøve\nForm", "Mål\n\nForm"),
    ("uis", "Mål\nEmnebeskrivelsen er hentet fra et system\nside 3\nPowered by TCPDF (x)", "Mål"),
    ("uis", "  EMNE ABC_1 NYNORSK Versjon 3\nMål\nFagpersoner\n- Bo Prøve\n\nForm\nKontakt\nAda Prøve\nRom 9", "Mål\n\nForm"),
    ("steiner", "Mål\nSide 2 av 9\nForm", "Mål\n\nForm"),
    ("usn", "Godkjent emneplan\nMål\nGodkjent 1.2.2020 av styret\nForm", "Mål\n\nForm"),
    ("uib", "Mål\nStudierettleiar: Ada\nStudieveileder: Bo\nEksamensadministrasjon: Rom 1\nKontakt: Rom 2\nForm", "Mål\n\nForm"),
    ("nmbu", "Mål\nEmneansvarlig: Ada Marie Prøve\nForm", "Mål\n\nForm"),
    ("uio", "spør Ada Marie Prøve (ada@prove.example.no) i skranken", "spør () i skranken"),
]

_LONG = "Emnet handler om språk og samfunn. " * 5
#: Status, type, page, heading, whether the heading says "not found", whether the page is usable.
STATUS = [
    (200, "text/html; charset=utf-8", f"<h1>Språk</h1><p>{_LONG}</p>", "Språk", False, True),
    (200, "text/html", f"<h1>Siden ble ikke funnet</h1><p>{_LONG}</p>", "Siden ble ikke funnet", True, False),
    (200, "text/html", f"<h1>Error 404</h1><p>{_LONG}</p>", "Error 404", True, False),
    (200, "text/html", "<p>X-17 kort</p>", None, False, True),
    (200, "text/html", "<p>kort</p><nav>X-17</nav><script>X-17</script>", None, False, False),
    (200, "application/pdf", f"<h1>Språk</h1><p>{_LONG}</p>", "Språk", False, False),
    (404, "text/html", f"<h1>Språk</h1><p>{_LONG}</p>", "Språk", False, False),
    (302, "text/html", f"<p>{_LONG}</p>", None, False, True),
    (200, "text/html", None, None, False, False),
    (None, "text/html", f"<p>{_LONG}</p>", None, False, False),
]

#: Page, the text of its article, the texts of its list entries and of paragraphs in its sections.
EXTRACTED = [
    ("<body><p>før</p><article><h2>Mål</h2><p>En  <b>to</b>\ntre</p></article></body>", "Mål\n\nEn to tre", None),
    ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table></article>", "a \tb\nc", None),
    ("<article>en<br>to</article><article>tre</article>", "en\nto", None),
    ("<ul><li>en<li> <li>to</ul><section><p>tre</p><div><p>fire</p></div></section><p>fem</p>", None, "en\nto\ntre"),
    ("<article> </article><li></li>", None, None),
    ("<p>ingen</p>", None, None),
    ("", None, None),
    (None, None, None),
]

#: Old text, new text, their differences as lines.
CHANGED = [
    ("En. To. Tre.", "En. To. Tre.", ""),
    ("En. To. Tre.", "En. To to. Tre.", "  En.\n- To.\n+ To to.\n  Tre."),
    ("En.\nTo.", "En.\nTo.\nTre.", "  En.\n  To.\n+ Tre."),
    ("En. To.", "To.", "- En.\n  To."),
    ("a.\nb.\nc.\nd.\ne.\nf.", "a.\nb.\nc.\nd.\ne.\ng.", "  c.\n  d.\n  e.\n- f.\n+ g."),
    (None, "En.", None),
    ("", "En.", "+ En."),
]

#: Institution, page, the error that it stands for.
ERRORS = [
    ("ntnu", "<p>Det finnes ingen informasjon for dette studieåret</p>", "ntnu_no_info_error"),
    ("ntnu", "<p>There is no information available for the given academic year.</p>", "ntnu_no_info_error"),
    ("hvl", "<h2>Vi kunne ikkje finne emnet du ser etter</h2>", "hvl_not_found_error"),
    ("hvl", "<p>Det finnes ingen informasjon for dette studieåret</p>", None),
    ("uia", "<h2>Vi kunne ikkje finne emnet du ser etter</h2>", None),
    ("ntnu", "<p>Emnet</p>", None),
    ("ntnu", None, None),
]


def _frame(spark, rows: list[tuple], schema: str):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k int, {schema}")


def _numbered(names: str, rows: list[tuple]) -> str:
    return values(f"k, {names}", [(k, *r) for k, r in enumerate(rows)])


def anonymize_cases(spark, folder):
    rows = _frame(spark, [r[:2] for r in CLEANED], "institution string, text string")
    return rows.select("k", text.anonymize(F.col("institution"), F.col("text")).alias("course_plan"))


def page_status_cases(spark, folder):
    rows = _frame(spark, [r[:3] for r in STATUS], "status int, kind string, html string").withColumn("f", page_facts(F.col("html")))
    ok = text.page_ok(F.col("status"), F.col("kind"), F.col("f.h1"), F.col("f.body"), F.lit("x-17"))
    return rows.select("k", F.col("f.h1").alias("h1"), text.lost(F.col("f.h1")).alias("lost"), ok.alias("ok"))


def extract_cases(spark, folder):
    rows = _frame(spark, [r[:1] for r in EXTRACTED], "html string")
    return rows.select("k", extract_css(F.col("html"), "article", before=text.break_cells).alias("article"), extract_css(F.col("html"), "li, section > p", "multi").alias("many"))


def text_diff_cases(spark, folder):
    rows = _frame(spark, [r[:2] for r in CHANGED], "old string, new string")
    return rows.select("k", unified(diff(F.col("old"), F.col("new"))).alias("changes"))


def soft_404_cases(spark, folder):
    rows = _frame(spark, [r[:2] for r in ERRORS], "institution string, html string")
    return rows.select("k", text.soft_404(F.col("institution"), F.col("html")).alias("error"))


#: Text cleaning steps: kind, text, result.
STEPS = [
    ("timetable", " Mål Vis detaljert timeplan uke 3\nrom 4", "Mål"),
    ("timetable", "Mål", "Mål"),
    ("render", "Mål Error rendering component x\ny", "Mål"),
    ("shadow", "  keyboard_backspace Mål \t\n\n\n\n  Form  ", "Mål\n\nForm"),
    ("module", "  Norsk   2 , Emne 3", "norsk2, emne 3"),
    ("module", "Musikk", "musikk"),
    ("pdf", "Side en|Side to\n\n\n\nslutt ", "Side en\nSide to\n\nslutt"),
    ("pdf", "|", None),
]


def text_step_cases(spark, folder):
    rows = _frame(spark, [r[:2] for r in STEPS], "kind string, text string")
    t, kind = F.col("text"), F.col("kind")
    out = F.when(kind == "timetable", text.cut_timetable(t)).when(kind == "render", text.cut_render_error(t)).when(kind == "shadow", text.shadow_text(t))
    out = out.when(kind == "module", text.module_name(t)).when(kind == "pdf", text.page_texts(F.split(t, r"\|")))
    return rows.select("k", out.alias("result"))


#: A listing of a course's terms and a menu of its documents.
LISTING = '<a href="/emne/AB1/77">2021 Haust</a><a href="/emne/AB1/x">2020 Vår</a><a href="/emne/CD2/5">2019 Vår</a><a href="/om">2018 Haust</a><a href="/emne/AB1/78">2022 Vår</a><a href="/emne/AB1/79">uten år</a>'
MENU = '<select><option value="/e?p_document_id=5">AB-1: H 2020</option><option value="/other">AB-1: V 2020</option><option value="/e?p_document_id=6">AB-1: V 2021</option><option value="/e?p_document_id=7">AB-1</option></select>'


def discover_links_cases(spark, folder):
    found = discovery.discover_links(spark.createDataFrame([("AB1", LISTING), ("EF3", None)], f"{CODE} string, html string"))
    return found.select(F.col(CODE).alias("code"), F.col(YEAR).alias("year"), F.col(SEASON).alias("season"), "url")


def discover_options_cases(spark, folder):
    found = discovery.discover_options(spark.createDataFrame([("AB1", MENU), ("EF3", "<p></p>")], f"{CODE} string, html string"))
    return found.select(F.col(CODE).alias("code"), F.col(YEAR).alias("year"), F.col(SEASON).alias("season"), "url")


def first_pdf_cases(spark, folder):
    rows = _frame(spark, [("<p>se https://a.example/x.pdf?v=1 og https://a.example/y.pdf</p>",), ('<iframe src="/z.pdf#1"></iframe>',), ("<p>ingen</p>",), (None,)], "html string")
    return rows.select("k", discovery.first_pdf(F.col("html")).alias("url"))


def one_page_for_a_code(spark, folder):
    """One fetched page handed on to all rows of its code."""
    rows = spark.createDataFrame([("a", "X1"), ("b", "X1"), ("c", "X2"), ("d", None)], f"id string, {CODE} string")
    pages = spark.createDataFrame([("X1", "<p>en</p>"), ("X3", "<p>tre</p>")], f"{CODE} string, html string")
    return joins.by_code(rows, pages).select("id", "html")


def known_codes(spark, folder):
    """Rows since 2015 whose code another table knows."""
    rows = spark.createDataFrame([("a", "X1", 2014), ("b", "X1", 2015), ("c", "X2", 2020), ("d", "X3", 2021), ("e", None, 2021)], f"id string, {CODE} string, `{YEAR}` int")
    codes = spark.createDataFrame([("X1",), ("X1",), ("X3",), (None,)], f"{CODE} string")
    return filters.known_since(rows, codes, CODE).select("id")


QUERIES = {
    "anonymize_cases": (anonymize_cases, _numbered("course_plan", [(r[2],) for r in CLEANED])),
    "page_status_cases": (page_status_cases, _numbered("h1, lost, ok", [r[3:] for r in STATUS])),
    "extract_cases": (extract_cases, _numbered("article, many", [r[1:] for r in EXTRACTED])),
    "text_diff_cases": (text_diff_cases, _numbered("changes", [(r[2],) for r in CHANGED])),
    "soft_404_cases": (soft_404_cases, _numbered("error", [(r[2],) for r in ERRORS])),
    "text_step_cases": (text_step_cases, _numbered("result", [(r[2],) for r in STEPS])),
    "first_pdf_cases": (first_pdf_cases, _numbered("url", [("https://a.example/x.pdf?v=1",), ("/z.pdf#1",), (None,), (None,)])),
    "discover_links_cases": (discover_links_cases, values("code, year, season, url", [("AB1", 2021, "Høst", "https://www.hivolda.no/emne/AB1/77"), ("AB1", 2022, "Vår", "https://www.hivolda.no/emne/AB1/78")])),
    "discover_options_cases": (discover_options_cases, values("code, year, season, url", [("AB1", 2020, "Høst", "https://uit.no/e?p_document_id=5"), ("AB1", 2021, "Vår", "https://uit.no/e?p_document_id=6")])),
    "one_page_for_a_code": (one_page_for_a_code, values("id, html", [("a", "<p>en</p>"), ("b", "<p>en</p>"), ("c", None), ("d", None)])),
    "known_codes": (known_codes, values("id", [("b",), ("d",)])),
}
