"""Quality, coverage and frequency reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text, mentions
from ..schema import RAW, YEAR


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def quality(courses: DataFrame) -> DataFrame:
    """Rows, codes, years, texts and plans of each institution.

    Rates are numbers; null where there is nothing to divide by.
    """
    text = has_text(F.col("extracted_text"))
    out = courses.groupBy("institution_short").agg(
        F.count("*").alias("rows"),
        F.countDistinct(RAW).alias("codes"),
        F.min(YEAR).alias("year_min"),
        F.max(YEAR).alias("year_max"),
        F.count_if(text).alias("has_text"),
        F.count("plan_content_id").alias("has_plan_id"),
        F.bround(F.median(F.when(text, F.length("extracted_text")))).cast("long").alias("median_chars"),
        F.countDistinct("plan_content_id").alias("unique_plans"),
    )
    years = F.when(F.col("year_min") == F.col("year_max"), F.col("year_min").cast("string")).otherwise(F.concat_ws("-", F.col("year_min").cast("string"), F.col("year_max").cast("string")))
    return out.withColumns({"years": years, "rate": _share(F.col("has_text"), F.col("rows")), "dedup_pct": 100.0 - _share(F.col("unique_plans"), F.col("has_plan_id"))})


def totals(courses: DataFrame, plans: DataFrame) -> DataFrame:
    """One row: all rows, those with text, their rate, and the rows of the plan lookup."""
    own = courses.select(F.lit(False).alias("plan"), has_text(F.col("extracted_text")).alias("text"))
    both = own.unionByName(plans.select(F.lit(True).alias("plan"), F.lit(False).alias("text")))
    out = both.agg(F.count_if(~F.col("plan")).alias("rows"), F.count_if("text").alias("has_text"), F.count_if("plan").alias("plans"))
    return out.withColumn("rate", _share(F.col("has_text"), F.col("rows")))


def markdown(courses: DataFrame, plans: DataFrame) -> str:
    """The quality report as a table of one line per institution and one of totals."""
    show = lambda x: "NA" if x is None else f"{x:.1f}%"
    lines = ["| Institution | Rows | Codes | Years | Extracted OK | Rate | Median chars | Unique plans | Dedup % |", "|------------|-----:|------:|-------|------------:|-----:|-------------:|-------------:|--------:|"]
    for r in quality(courses).orderBy("institution_short").collect():  # one row for each institution
        cells = (r["institution_short"], r["rows"], r["codes"], r["years"], r["has_text"], show(r["rate"]), "NA" if r["median_chars"] is None else r["median_chars"], r["unique_plans"], show(r["dedup_pct"]))
        lines.append("| " + " | ".join(map(str, cells)) + " |")
    t = totals(courses, plans).first()
    lines.append(f"| **Total** | **{t['rows']}** | | | **{t['has_text']}** | **{show(t['rate'])}** | | **{t['plans']}** | |")
    return "\n".join(lines) + "\n"


def dedup_ratio(courses: DataFrame, plans: DataFrame) -> DataFrame:
    """One row: 1 - plans / rows, rows without a plan included."""
    both = courses.select(F.lit(False).alias("plan")).unionByName(plans.select(F.lit(True).alias("plan")))
    out = both.agg(F.count_if(~F.col("plan")).alias("courses"), F.count_if("plan").alias("plans"))
    return out.withColumn("ratio", 1 - F.try_divide(F.col("plans"), F.col("courses")))


def dedup_by_institution(courses: DataFrame) -> DataFrame:
    """Rows and distinct plans of each institution; a missing plan counts as one."""
    plans = F.countDistinct("plan_content_id") + F.max(F.col("plan_content_id").isNull().cast("long"))
    out = courses.groupBy("institution_short").agg(F.count("*").alias("rows"), plans.alias("unique_plans"))
    return out.withColumn("dedup_pct", (1 - F.col("unique_plans") / F.col("rows")) * 100).orderBy("institution_short")


def funnel(courses: DataFrame, by: str = "institution_short") -> DataFrame:
    """How many rows have an address, a fetched page and a text."""
    return courses.groupBy(by).agg(F.count("*").alias("rows"), F.count("url").alias("urls"), F.count_if(F.coalesce("html_success", F.lit(False))).alias("pages"), F.count("extracted_text").alias("texts"))


def routes(matched: DataFrame) -> DataFrame:
    """Rows by how they are to be fetched, as one row."""
    return matched.agg(*[F.count_if(F.col("route") == k).alias(k) for k in ("html", "pdf", "none")])


def coverage(courses: DataFrame, by: str = "Avdelingsnavn") -> DataFrame:
    """Addresses, pages and texts of each department, largest first."""
    out = courses.groupBy(by).agg(F.count("*").alias("total"), F.count("url").alias("with_url"), F.count_if(F.coalesce("html_success", F.lit(False))).alias("with_html"), F.count_if(has_text(F.col("extracted_text"))).alias("with_text"))
    return out.withColumns({f"pct_{k}": _share(F.col(f"with_{k}"), F.col("total")) for k in ("url", "html", "text")}).orderBy(F.desc("total"), by)


def frequencies(rows: DataFrame, *by: str) -> DataFrame:
    """Counts of each combination of values, most frequent first."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)


def length_stats(rows: DataFrame, text: str = "extracted_text", by: str | None = None) -> DataFrame:
    """Least, greatest, mean and median length of the texts, and the upper of two middle lengths."""
    own = rows.where(has_text(F.col(text))).withColumn("_n", F.length(text))
    aggs = [F.count("*").alias("texts"), F.min("_n").alias("least"), F.max("_n").alias("greatest"), F.bround(F.avg("_n")).cast("long").alias("mean"), F.median("_n").alias("median"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _n DESC)").cast("long").alias("upper_median")]
    return (own.groupBy(by) if by else own).agg(*aggs)


def distinct_codes(rows: DataFrame, code: str = RAW) -> DataFrame:
    return rows.agg(F.countDistinct(code).alias("codes"))


def code_mentions(rows: DataFrame, code: str = RAW, by: str = "institution_short") -> DataFrame:
    """How many texts mention their course's code."""
    return rows.where(has_text(F.col("extracted_text"))).groupBy(by).agg(F.count("*").alias("texts"), F.count_if(mentions(F.col("extracted_text"), F.col(code))).alias("mention_code"))


def failures(rows: DataFrame) -> DataFrame:
    """Rows whose fetch failed, and rows that had no address, with the reason."""
    reason = F.when(F.col("url").isNull(), "no url").when(F.col("html_error").isNotNull(), F.col("html_error.message"))
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull())


def validation(rows: DataFrame, code: str = RAW) -> DataFrame:
    """Of each row its address, whether it was fetched, names its code and gave text, and what failed."""
    got = F.coalesce(F.col("html_success"), F.lit(False))
    reason = F.when(F.col("url").isNull(), "no url").when(F.col("html_error").isNotNull(), F.col("html_error.message"))
    return rows.select(F.col(code).alias("code"), F.col(YEAR).alias("year"), "url", got.alias("fetched"), mentions(F.col("html"), F.col(code)).alias("code_found"), F.when(has_text(F.col("extracted_text")), F.length("extracted_text")).alias("text_length"), reason.alias("reason"))


def validation_report(rows: DataFrame, title: str = "Validation") -> DataFrame:
    """The report as lines of text in order, a summary and then a block for each row; written with ``write.text``."""
    own = validation(rows)
    counts = own.agg(F.count("*").alias("n"), F.count_if("fetched").alias("fetched"), F.count_if(F.col("text_length").isNotNull()).alias("texts"), F.round(F.avg("text_length")).cast("long").alias("mean"))
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])
    head = counts.select(F.lit(0).alias("part"), F.lit("").alias("code"), F.lit(0).alias("year"), F.array(F.lit(title), line("Rows: ", F.col("n")), line("Fetched: ", F.col("fetched")), line("With text: ", F.col("texts")), line("Mean length: ", F.col("mean"))).alias("lines"))
    some = lambda ok, *parts: F.when(ok, line(*parts))
    block = F.array(line(F.col("code"), " (", F.col("year"), ")"), line("  URL: ", F.col("url")), line("  Fetch: ", F.when(F.col("fetched"), "OK").otherwise("FAILED")), some(F.col("code_found"), "  Course code found"), some(F.col("text_length").isNotNull(), "  Text: ", F.col("text_length"), " chars"), some(F.col("reason").isNotNull(), "  Error: ", F.col("reason")))
    body = own.select(F.lit(1).alias("part"), "code", "year", F.filter(block, lambda x: x.isNotNull()).alias("lines"))
    return head.unionByName(body).orderBy("part", "code", "year").select(F.explode("lines").alias("value"))
