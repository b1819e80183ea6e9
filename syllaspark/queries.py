"""The registered queries of the course-plan operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cases
from .functions import discovery, keys, pdf, text
from .functions.diff import diff, unified
from .functions.embedded import embedded_plan
from .functions.html import extract_css, page_facts
from .functions.rules import GENERAL, HEADINGS
from .operators import columns, filters, joins, plans, reports, sets
from .plans.registry import INSTITUTIONS, dimension
from .plans.views import courses, planned, table
from .schema import CODE, RAW, SEASON, YEAR
from .session import ship, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


_NAMES = "[" + ", ".join(f"'{n}'" for n in INSTITUTIONS) + "]"
_HEADINGS = "|".join(HEADINGS)


def _c(institution: str = "lang") -> str:
    """The course view in SQL, as ``c``."""
    return f"""c0 AS (SELECT doc_id, {institution} AS institution_short, concat('C', n_chars % 7, '-1') AS "Emnekode_raw", concat('C', n_chars % 7) AS "Emnekode",
 concat('Course ', doc_id % 50) AS "Emnenavn", CAST(2004 + doc_id % 22 AS INTEGER) AS "Årstall", CASE WHEN doc_id % 2 = 0 THEN 'Vår' ELSE 'Høst' END AS "Semesternavn",
 CAST(1 + doc_id % 4 AS INTEGER) AS "Status", source AS "Avdelingsnavn", text,
 CASE WHEN doc_id % 5 <> 0 THEN concat('https://example.org/?a=1&d=', doc_id) END AS url FROM documents),
c AS (SELECT * EXCLUDE (text), concat_ws('_', coalesce(institution_short, 'NA'), "Emnekode_raw", "Årstall", CASE "Semesternavn" WHEN 'Vår' THEN 'spring' ELSE 'autumn' END, "Status") AS course_id,
 text || chr(10) || 'Learning outcomes autumn ' || "Årstall" || ' Opprettet ' || "Årstall" AS extracted_text FROM c0)"""


_REGISTRY = f"{_NAMES}[doc_id % {len(INSTITUTIONS)} + 1]"
_SQUISH = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_P = (
    _c()
    + rf""",
n AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(extracted_text), '\b({_HEADINGS})\b', '', 'g'),
 '\b(høst|vår|haust|autumn|spring|sommer|summer)\b', '', 'g'), '\b(19|20)\d{{2}}\b', '', 'g'), '\beksamensformer\b', 'vurderingsformer', 'g'), '\s+', ' ', 'g')) AS course_plan_normalized FROM c),
p AS (SELECT *, CASE WHEN course_plan_normalized <> '' THEN sha256(course_plan_normalized) END AS plan_content_id FROM n)"""
)
_LOOKUP = """l AS (SELECT plan_content_id, institution_short, "Emnekode", min("Årstall") AS year_from, max("Årstall") AS year_to,
 arg_min(extracted_text, ("Årstall", doc_id)) AS course_plan, arg_min(course_plan_normalized, ("Årstall", doc_id)) AS course_plan_normalized
 FROM p WHERE plan_content_id IS NOT NULL GROUP BY ALL)"""


# --- keys, addresses and filters ---


@query(f"""WITH {_c()} SELECT doc_id, course_id, "Emnekode" AS code, CASE "Semesternavn" WHEN 'Vår' THEN 'spring' ELSE 'autumn' END AS season FROM c""")
def course_key(spark, folder):
    rows = courses(spark, folder)
    return rows.select("doc_id", "course_id", keys.strip_version(F.col(RAW)).alias("code"), keys.season_english(F.col(SEASON)).alias("season"))


_SLUG = """CASE "Semesternavn" WHEN 'Vår' THEN 'var' ELSE 'host' END"""


@query(f"""WITH {_c(_REGISTRY)} SELECT doc_id, institution_short, CASE institution_short
 WHEN 'oslomet' THEN concat('https://student.oslomet.no/studier/-/studieinfo/emne/', upper("Emnekode"), '/', "Årstall", '/HØST')
 WHEN 'uia' THEN concat('https://www.uia.no/studier/emner/', "Årstall", '/', {_SLUG}, '/', lower("Emnekode"), '.html')
 WHEN 'ntnu' THEN concat('https://www.ntnu.no/studier/emner/', upper("Emnekode"), '/', "Årstall")
 WHEN 'inn' THEN CASE WHEN "Årstall" >= 2022 THEN concat('https://studiekatalog.edutorium.no/inn/nb/emne/', "Emnekode", '/', "Årstall", '-', {_SLUG}) END
 WHEN 'hiof' THEN concat('https://www.hiof.no/studier/emner/', CASE WHEN "Årstall" < 2021 OR ("Årstall" = 2021 AND "Semesternavn" = 'Vår') THEN 'historiske-emner/lu/' ELSE 'lusp/lusp/' END, "Årstall", '/', {_SLUG}, '/', lower("Emnekode"), '.html')
 WHEN 'hvl' THEN concat('https://www.hvl.no/studier/studieprogram/emne/', "Årstall", '/', "Emnekode")
 WHEN 'mf' THEN concat('https://mf.no/studier/emner/', lower("Emnekode"))
 WHEN 'nla' THEN concat('https://www.nla.no/for-studenter/Studie-%20og%20emneplaner/emneplan/', "Emnekode", '/', "Årstall" - CASE WHEN "Semesternavn" = 'Vår' THEN 1 ELSE 0 END, '-', "Årstall" + CASE WHEN "Semesternavn" = 'Vår' THEN 0 ELSE 1 END)
 WHEN 'nord' THEN concat('https://www.nord.no/studier/emner/', lower("Emnekode"), '?year=', "Årstall", '&semester=', CASE "Semesternavn" WHEN 'Vår' THEN 'V%C3%85R' ELSE 'H%C3%98ST' END)
 WHEN 'nih' THEN concat('https://www.nih.no/studier/emner/', "Årstall", '/', {_SLUG}, '/', lower("Emnekode"), '.html')
 WHEN 'uib' THEN concat('https://www4.uib.no/studier/emner/', lower("Emnekode"), '?start_semester=', "Årstall", CASE "Semesternavn" WHEN 'Vår' THEN 'V' ELSE 'H' END)
 WHEN 'uis' THEN concat('https://www.uis.no/nb/student/course/', upper(replace("Emnekode_raw", '-', '_')))
 WHEN 'nmbu' THEN concat('https://www.nmbu.no/emne/', upper("Emnekode")) END AS url FROM c""")
def course_url(spark, folder):
    return columns.with_url(courses(spark, folder, registry=True)).select("doc_id", "institution_short", "url")


@query(f"""WITH {_c()} SELECT doc_id, institution_short, "Årstall" AS year FROM c QUALIFY "Årstall" = max("Årstall") OVER (PARTITION BY institution_short)""")
def latest_year_filter(spark, folder):
    return filters.latest_year(courses(spark, folder)).select("doc_id", "institution_short", F.col(YEAR).alias("year"))


@query(f"""WITH {_c()} SELECT doc_id, course_id FROM c WHERE institution_short IN ('en', 'de') AND "Årstall" BETWEEN 2010 AND 2020 AND "Semesternavn" IN ('Høst') AND "Status" IN (2, 4) AND length(extracted_text) > 0""")
def browse_filter(spark, folder):
    return filters.browse(courses(spark, folder), ["en", "de"], (2010, 2020), ["Høst"], ["2", "4"], True).select("doc_id", "course_id")


@query(f"""WITH {_c(_REGISTRY)} SELECT CASE institution_short WHEN 'hivolda' THEN 'Hivolda' WHEN 'nord' THEN 'Nord' WHEN 'samas' THEN 'Samas' WHEN 'steiner' THEN 'Steiner' WHEN 'hiof' THEN 'HiOF' WHEN 'oslomet' THEN 'OsloMet'
 WHEN 'uia' THEN 'UiA' WHEN 'uib' THEN 'UiB' WHEN 'uio' THEN 'UiO' WHEN 'uis' THEN 'UiS' WHEN 'uit' THEN 'UiT' ELSE upper(institution_short) END AS "Institution",
 "Emnekode_raw" AS "Code", "Emnenavn" AS "Name", "Årstall" AS "Year", "Semesternavn" AS "Semester", ['Active', 'New', 'Discontinued', 'Disc. w/ exam']["Status"] AS "Status",
 CASE WHEN length(extracted_text) > 0 THEN 'Yes' ELSE 'No' END AS "Text",
 coalesce('<a href="' || replace(url, '&', '&amp;') || '" target="_blank" title="' || replace(url, '&', '&amp;') || '">Link</a>', '') AS "URL" FROM c""")
def browse_display(spark, folder):
    return columns.display(courses(spark, folder, registry=True))


@query(f"""WITH {_c()} SELECT course_id, doc_id FROM c ORDER BY "Årstall", course_id, doc_id LIMIT 10 OFFSET 20""")
def browse_page(spark, folder):
    return filters.page(courses(spark, folder), [F.col(YEAR), F.col("course_id"), F.col("doc_id")], 2).select("course_id", "doc_id")


@query(f"""WITH {_c(_REGISTRY)} SELECT institution_short, count(*) AS n FROM c GROUP BY ALL""")
def institution_names(spark, folder):
    dim = dimension(spark)
    coded = courses(spark, folder, registry=True).select("doc_id", "institution_short").join(F.broadcast(dim.select("institution_short", F.col("code").alias("Institusjonskode"))), "institution_short").drop("institution_short")
    return columns.institution_of(coded, dim).groupBy("institution_short").agg(F.count("*").alias("n"))


# --- texts and plans ---


@query(f"WITH {_P} SELECT doc_id, course_plan_normalized, plan_content_id FROM p")
def normalize_hash(spark, folder):
    return planned(spark, folder).select("doc_id", "course_plan_normalized", "plan_content_id")


@query(f"WITH {_P}, {_LOOKUP} SELECT * FROM l")
def plan_lookup(spark, folder):
    return plans.plan_lookup(planned(spark, folder), "doc_id")


@query(f"""WITH {_P} SELECT institution_short, "Emnekode_raw", count(DISTINCT plan_content_id) AS versions FROM p WHERE plan_content_id IS NOT NULL GROUP BY ALL HAVING versions >= 2""")
def multi_version_codes(spark, folder):
    return plans.multi_version_codes(planned(spark, folder))


_VERSIONS = """g AS (SELECT institution_short, "Emnekode_raw", plan_content_id, min("Årstall") AS year_from, max("Årstall") AS year_to, count(*) AS semesters,
 arg_min(extracted_text, ("Årstall", "Semesternavn", doc_id)) AS extracted_text, arg_min(course_plan_normalized, ("Årstall", "Semesternavn", doc_id)) AS course_plan_normalized FROM p WHERE plan_content_id IS NOT NULL GROUP BY ALL),
v AS (SELECT *, CAST(row_number() OVER (PARTITION BY institution_short, "Emnekode_raw" ORDER BY year_from, year_to, plan_content_id) AS INTEGER) AS number FROM g),
w AS (SELECT institution_short, "Emnekode_raw", number, concat('V', number, ' (', year_from, CASE WHEN year_from = year_to THEN '' ELSE concat('-', year_to) END, ')') AS label, plan_content_id, substr(plan_content_id, 1, 8) AS hash_short, year_from, year_to, semesters, extracted_text, course_plan_normalized FROM v)"""


@query(f"WITH {_P}, {_VERSIONS} SELECT * FROM w")
def plan_versions(spark, folder):
    return plans.plan_versions(planned(spark, folder), "doc_id")


@query(f"""WITH {_P}, {_VERSIONS}, x AS (SELECT institution_short, "Emnekode_raw", number, lag(label) OVER o AS old_label, label AS new_label, lag(course_plan_normalized) OVER o AS old_text, course_plan_normalized AS new_text FROM w WINDOW o AS (PARTITION BY institution_short, "Emnekode_raw" ORDER BY number))
SELECT *, trim(old_text, chr(32) || chr(9) || chr(10) || chr(13)) = trim(new_text, chr(32) || chr(9) || chr(10) || chr(13)) AS same FROM x WHERE number > 1""")
def version_pairs(spark, folder):
    return plans.version_pairs(plans.plan_versions(planned(spark, folder), "doc_id"))


@query(f"""WITH {_c()} SELECT doc_id, course_id FROM c QUALIFY row_number() OVER (PARTITION BY course_id ORDER BY "Status", doc_id) = 1""")
def first_per_course(spark, folder):
    return plans.first_per_course(courses(spark, folder), "doc_id").select("doc_id", "course_id")


def _sql_rules() -> str:
    """The general rules in SQL; the one with a look-behind has no match in the tables and none in RE2."""
    out = "text"
    for rule in GENERAL:
        if "(?<=" not in rule.pattern:
            put = rule.put.replace("$1", "\\1").replace("\n", "' || chr(10) || '")
            out = f"regexp_replace({out}, '{rule.pattern}', '{put}', 'g')"
    return f"trim({out}, chr(32) || chr(9) || chr(10) || chr(13))"


@query(f"SELECT doc_id, nullif({_sql_rules()}, '') AS course_plan FROM documents")
def anonymize_general(spark, folder):
    return spread(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", text.anonymize(F.lit("other"), F.col("text")).alias("course_plan"))


@query()
def anonymize_institutions(spark, folder):
    rows = courses(spark, folder, registry=True).select("doc_id", "institution_short", "extracted_text")
    return plans.clean(spread(rows)).select("doc_id", "institution_short", "course_plan")


# --- reports ---


@query(f"""WITH {_P} SELECT institution_short, count(*) AS rows, count(DISTINCT "Emnekode_raw") AS codes, min("Årstall") AS year_min, max("Årstall") AS year_max,
 count(*) FILTER (length(extracted_text) > 0) AS has_text, count(plan_content_id) AS has_plan_id, CAST(round_even(median(length(extracted_text)) FILTER (length(extracted_text) > 0), 0) AS BIGINT) AS median_chars,
 count(DISTINCT plan_content_id) AS unique_plans, CASE WHEN year_min = year_max THEN CAST(year_min AS VARCHAR) ELSE concat(year_min, '-', year_max) END AS years,
 has_text * 100.0::DOUBLE / rows AS rate, 100.0::DOUBLE - unique_plans * 100.0::DOUBLE / nullif(has_plan_id, 0) AS dedup_pct FROM p GROUP BY institution_short""")
def quality_report(spark, folder):
    return reports.quality(planned(spark, folder))


@query(f"WITH {_P}, {_LOOKUP} SELECT count(*) AS rows, count(*) FILTER (length(extracted_text) > 0) AS has_text, (SELECT count(*) FROM l) AS plans, has_text * 100.0::DOUBLE / rows AS rate FROM p")
def quality_totals(spark, folder):
    rows = planned(spark, folder)
    return reports.totals(rows, plans.plan_lookup(rows, "doc_id"))


@query(f"WITH {_P}, {_LOOKUP} SELECT *, 1 - plans::DOUBLE / courses AS ratio FROM (SELECT count(*) AS courses, (SELECT count(*) FROM l) AS plans FROM p)")
def dedup_summary(spark, folder):
    rows = planned(spark, folder)
    return reports.dedup_ratio(rows, plans.plan_lookup(rows, "doc_id"))


@query(f"WITH {_P} SELECT institution_short, count(*) AS rows, count(DISTINCT plan_content_id) + max(CASE WHEN plan_content_id IS NULL THEN 1 ELSE 0 END) AS unique_plans, (1 - unique_plans / rows) * 100 AS dedup_pct FROM p GROUP BY institution_short")
def dedup_summary_na(spark, folder):
    return reports.dedup_by_institution(planned(spark, folder))


@query(f"""WITH {_c()} SELECT institution_short, count(*) AS rows, count(url) AS urls, count(*) FILTER (doc_id % 3 = 0) AS pages, count(extracted_text) AS texts FROM c GROUP BY institution_short""")
def funnel(spark, folder):
    return reports.funnel(courses(spark, folder).withColumn("html_success", F.col("doc_id") % 3 == 0))


@query(f"""WITH {_c()} SELECT "Avdelingsnavn", count(*) AS total, count(url) AS with_url, count(*) FILTER (doc_id % 3 = 0) AS with_html, count(*) FILTER (length(extracted_text) > 0) AS with_text,
 with_url * 100.0::DOUBLE / total AS pct_url, with_html * 100.0::DOUBLE / total AS pct_html, with_text * 100.0::DOUBLE / total AS pct_text FROM c GROUP BY "Avdelingsnavn" """)
def faculty_coverage(spark, folder):
    return reports.coverage(courses(spark, folder).withColumn("html_success", F.col("doc_id") % 3 == 0))


@query(f"""WITH {_c()} SELECT "Årstall" AS year, "Semesternavn" AS season, count(*) AS n FROM c GROUP BY ALL""")
def freq_table(spark, folder):
    return reports.frequencies(courses(spark, folder).select(F.col(YEAR).alias("year"), F.col(SEASON).alias("season")), "year", "season")


@query(f"""WITH {_c()}, x AS (SELECT institution_short, length(extracted_text) AS n FROM c WHERE length(extracted_text) > 0)
SELECT institution_short, count(*) AS texts, CAST(min(n) AS INTEGER) AS least, CAST(max(n) AS INTEGER) AS greatest, CAST(round_even(avg(n), 0) AS BIGINT) AS mean, median(n) AS median, CAST(list_sort(list(n))[count(*) // 2 + 1] AS BIGINT) AS upper_median FROM x GROUP BY institution_short""")
def length_stats(spark, folder):
    return reports.length_stats(courses(spark, folder), by="institution_short")


@query(f"""WITH {_c()} SELECT count(DISTINCT "Emnekode_raw") AS codes FROM c""")
def distinct_codes(spark, folder):
    return reports.distinct_codes(courses(spark, folder))


@query(f"""WITH {_c()} SELECT institution_short, count(*) AS texts, count(*) FILTER (contains(lower(extracted_text), lower("Avdelingsnavn"))) AS mention_code FROM c WHERE length(extracted_text) > 0 GROUP BY institution_short""")
def code_mentions(spark, folder):
    return reports.code_mentions(courses(spark, folder), "Avdelingsnavn")


# --- joins, sets and samples ---

_DONE = """k AS (SELECT c.course_id, concat('<p>', l.doc_id, '</p>') AS html, l.quality = 1 AS html_success, l.doc_id FROM labels l JOIN c ON c.doc_id = l.doc_id)"""


def _checkpoint(spark, folder):
    done = table(spark, folder, "labels").join(courses(spark, folder).select("doc_id", "course_id"), "doc_id")
    return done.select("course_id", F.concat(F.lit("<p>"), F.col("doc_id").cast("string"), F.lit("</p>")).alias("html"), F.lit(None).cast("struct<class:string,message:string>").alias("html_error"), (F.col("quality") == 1).alias("html_success"), F.col("doc_id").alias("fetched_at"))


@query(f"WITH {_c()}, {_DONE} SELECT doc_id, course_id FROM c WHERE url <> '' AND NOT EXISTS (SELECT 1 FROM k WHERE k.course_id = c.course_id)")
def checkpoint_todo(spark, folder):
    return joins.todo(courses(spark, folder), _checkpoint(spark, folder)).select("doc_id", "course_id")


@query(f"WITH {_c()}, {_DONE}, f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY course_id ORDER BY doc_id) = 1) SELECT c.doc_id, c.course_id, f.html, f.html_success FROM c LEFT JOIN f USING (course_id)")
def checkpoint_merge(spark, folder):
    return joins.merge_checkpoint(courses(spark, folder), _checkpoint(spark, folder), [F.col("fetched_at")]).select("doc_id", "course_id", "html", "html_success")


@query(f"WITH {_c()} SELECT c.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.toxic = 0 THEN concat('new', l.doc_id) END ELSE c.url END AS url FROM c LEFT JOIN labels l ON l.doc_id = c.doc_id")
def rows_update(spark, folder):
    updates = table(spark, folder, "labels").select("doc_id", F.when(F.col("toxic") == 0, F.concat(F.lit("new"), F.col("doc_id").cast("string"))).alias("url"))
    return joins.update_rows(courses(spark, folder), updates, "doc_id").select("doc_id", "url")


@query(f"""WITH {_c()}, u AS (SELECT "Emnekode", "Årstall", "Semesternavn", min(url) AS url FROM c WHERE url IS NOT NULL GROUP BY ALL)
SELECT c.doc_id, u.url FROM c LEFT JOIN u USING ("Emnekode", "Årstall", "Semesternavn")""")
def lookup_join(spark, folder):
    rows = courses(spark, folder)
    return joins.lookup_url(rows, rows.where("url is not null"), [F.col("url")]).select("doc_id", "url")


@query(f"""WITH {_c()}, d AS (SELECT concat('C', page_id % 7, '-1') AS "Emnekode_raw", CAST(2004 + page_id % 40 AS INTEGER) AS "Årstall", url AS u, CASE WHEN page_id % 3 = 0 THEN 'pdf' ELSE 'html' END AS t FROM pages),
f AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY "Emnekode_raw", "Årstall" ORDER BY t <> 'html', u) = 1),
m AS (SELECT doc_id, coalesce(f.u, c.url) AS url, f.t IS NOT NULL AS url_matched, coalesce(f.t, 'html') AS t FROM c LEFT JOIN f USING ("Emnekode_raw", "Årstall"))
SELECT doc_id, url, url_matched, CASE WHEN url IS NULL THEN 'none' ELSE t END AS route FROM m""")
def discovery_router(spark, folder):
    pages = table(spark, folder, "pages")
    found = pages.select(F.concat(F.lit("C"), (F.col("page_id") % 7).cast("string"), F.lit("-1")).alias(RAW), (2004 + F.col("page_id") % 40).cast("int").alias("year"), "url", F.when(F.col("page_id") % 3 == 0, "pdf").otherwise("html").alias("type"))
    return joins.match_discovery(courses(spark, folder), found).select("doc_id", "url", "url_matched", "route")


@query(f"WITH x AS ({ORACLES['discovery_router']}) SELECT count(*) FILTER (route = 'html') AS html, count(*) FILTER (route = 'pdf') AS pdf, count(*) FILTER (route = 'none') AS none FROM x")
def route_counts(spark, folder):
    return reports.routes(discovery_router(spark, folder))


@query(f"""WITH {_c()} SELECT "Emnekode" AS code, min(url) AS url FROM c WHERE url IS NOT NULL GROUP BY "Emnekode" """)
def fetch_once(spark, folder):
    return joins.fetch_once(courses(spark, folder), CODE, [F.col("url")]).select(F.col(CODE).alias("code"), "url")


@query("SELECT doc_id, text, lang, NULL::INTEGER AS quality, NULL::INTEGER AS toxic FROM documents UNION ALL SELECT doc_id, NULL, NULL, quality, toxic FROM labels")
def bind_rows_fill(spark, folder):
    return sets.bind_rows(table(spark, folder, "documents").select("doc_id", "text", "lang"), table(spark, folder, "labels")).select("doc_id", "text", "lang", "quality", "toxic")


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def key_intersect(spark, folder):
    return sets.common_keys(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def key_setdiff(spark, folder):
    return sets.only_left(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")


@query("SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS matched, (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS only_left, (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) AS only_right")
def key_diagnostics(spark, folder):
    return sets.key_diagnostics(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")


@query(f"""WITH {_c()}, d AS (SELECT doc_id, "Årstall", "Semesternavn", sha256(concat(doc_id, '42')) AS h FROM c), r AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY "Årstall", "Semesternavn" ORDER BY h) <= 2)
SELECT doc_id FROM r ORDER BY h LIMIT 20""")
def stratified_sample(spark, folder):
    return sets.stratified(courses(spark, folder), [YEAR, SEASON], F.col("doc_id")).select("doc_id")


# --- pages ---


@query("""SELECT page_id, nullif(trim(replace(replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')), '') AS h1 FROM pages""")
def extract_h1(spark, folder):
    return table(spark, folder, "pages").select("page_id", extract_css(F.col("html"), "h1").alias("h1"))


@query()
def extract_article(spark, folder):
    return table(spark, folder, "pages").select("page_id", extract_css(F.col("html"), "article", before=text.break_cells).alias("text"))


@query()
def extract_multi(spark, folder):
    return table(spark, folder, "pages").select("page_id", extract_css(F.col("html"), "article p, li, div > p", "multi").alias("text"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 AND regexp_matches(html, 'Det finnes ingen informasjon for dette studieåret|There is no information available for the given academic year') THEN 'ntnu_no_info_error' WHEN page_id % 2 = 1 AND contains(html, 'Vi kunne ikkje finne emnet du ser etter') THEN 'hvl_not_found_error' END AS error FROM pages")
def soft_404(spark, folder):
    institution = F.when(F.col("page_id") % 2 == 0, "ntnu").otherwise("hvl")
    return table(spark, folder, "pages").select("page_id", text.soft_404(institution, F.col("html")).alias("error"))


@query()
def page_status(spark, folder):
    facts = table(spark, folder, "pages").select("page_id", page_facts(F.col("html")).alias("f"))
    ok = text.page_ok(F.lit(200), F.lit("text/html; charset=utf-8"), F.col("f.h1"), F.col("f.body"), F.col("page_id").cast("string"))
    return facts.select("page_id", F.col("f.h1").alias("h1"), text.lost(F.col("f.h1")).alias("soft_404"), F.octet_length("f.body").alias("bytes"), ok.alias("ok"))


@query()
def text_diff(spark, folder):
    ship(spark)  # for its small Arrow batches
    pairs = plans.version_pairs(plans.plan_versions(planned(spark, folder), "doc_id"), "extracted_text")
    return pairs.select("institution_short", RAW, "number", unified(diff(F.col("old_text"), F.col("new_text"), words=False)).alias("changes"))


# --- recorded pages, as inline rows ---

_NLA = """<html><script>x</script><script>React(EmneplanPage, {"props": {"items": {"2023-2024": {"title": "Norsk 1", "table": [{"title": "Poeng", "content": "15"}, {"title": "Tom", "content": ""}], "accordions": [{"title": "Innhold", "content": "<p>En</p><p>To</p>"}]}}}})</script></html>"""


@query("SELECT '2023-2024' AS year, concat('Norsk 1', chr(10), chr(10), 'Poeng: 15', chr(10), chr(10), 'Innhold', chr(10), 'En', chr(10), chr(10), 'To') AS plan UNION ALL SELECT '2020-2021', NULL")
def nla_json(spark, folder):
    rows = spark.createDataFrame([("2023-2024", _NLA), ("2020-2021", _NLA)], "year string, html string")
    return rows.select("year", embedded_plan(F.col("html"), F.col("year")).alias("plan"))


_MENU = """<select id="fs-semester-select" data-older='[{"label": "2016 - 2017", "url": "https://old.example/a.pdf"}]'><option value="/nb/x/1">2025 - 2026</option><option value="https://doc.example/b.pdf"> 2019 - 2020 </option></select>"""


@query("SELECT * FROM (VALUES ('2025 - 2026', 'https://www.uis.no/nb/x/1', 'html', 2025, 'A-1'), ('2019 - 2020', 'https://doc.example/b.pdf', 'pdf', 2019, 'A-1'), ('2016 - 2017', 'https://old.example/a.pdf', 'pdf', 2016, 'A-1')) AS t(label, url, type, year, code)")
def uis_dropdown(spark, folder):
    rows = spark.createDataFrame([("A-1", _MENU), ("B-1", "<p>none</p>"), ("C-1", None)], f"{RAW} string, html string")
    return discovery.discover_menu(rows).withColumnRenamed(RAW, "code")


@query("SELECT * FROM (VALUES ('Norsk 1, emne 1', concat('Norsk 1, emne 1', chr(10), 'Innhold', chr(10), chr(10), 'Mer')), ('Norsk 1, emne 2', 'Norsk 1, emne 2')) AS t(pdf_emne_name, extracted_text)")
def pdf_sections(spark, folder):
    pages = ["Forside", "Norsk 1, emne 1-2", "Norsk 1, emne 1\n  Innhold  ", "Mer\nSide 3 av 4", "  Norsk 1, emne 2"]
    rows = spark.createDataFrame([("Norsk", "u", pages)], "subject string, url string, pages array<string>")
    return pdf.sections(rows).select("pdf_emne_name", "extracted_text")


@query("SELECT * FROM (VALUES ('a', 2), ('b', NULL), ('c', NULL), ('d', NULL)) AS t(course_id, version)")
def usn_probe(spark, folder):
    rows = [
        ("a", "X1", 2024, "Høst", 1, "X1 Undervisningsstart vår 2020"),
        ("a", "X1", 2024, "Høst", 2, "X1 UNDERVISNINGSSTART høst 2024"),
        ("b", "X2", 2022, "Høst", 1, "X2 Undervisningsstart høst 2025"),
        ("b", "X2", 2022, "Høst", 2, "X2 Undervisningsstart høst 2022"),
        ("c", "X3", 2022, "Vår", 1, "another course"),
        ("c", "X3", 2022, "Vår", 2, "X3 Undervisningsstart vår 2022"),
        ("d", "X4", 2022, "Vår", 1, None),
    ]
    found = discovery.probe_versions(spark.createDataFrame(rows, f"course_id string, {CODE} string, `{YEAR}` int, {SEASON} string, version int, content string"))
    return found.select("course_id", "version")


# --- rules and pages case by case ---

for _name, (_run, _sql) in cases.QUERIES.items():
    QUERIES[_name], ORACLES[_name] = _run, _sql


def entry(spark: SparkSession, folder: str) -> DataFrame:
    """Plans by content over the smallest tables."""
    return plans.plan_lookup(planned(spark, folder), "doc_id")
