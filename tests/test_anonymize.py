"""Cleaning rules: the inline cases, and how the whole chain is planned."""

import re

import pytest
from pyspark.sql import functions as F

from syllaspark import cases
from syllaspark.functions.rules import BY_INSTITUTION, GENERAL
from syllaspark.functions.text import anonymize, normalize_plan
from syllaspark.operators import plans
from syllaspark.schema import CODE, RAW, SEASON, YEAR


def _clean(spark, rows):
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, i string, t string")
    return [r["p"] for r in frame.select("k", anonymize(F.col("i"), F.col("t")).alias("p")).orderBy("k").collect()]


def test_every_case(spark):
    for (institution, text, want), got in zip(cases.CLEANED, _clean(spark, [c[:2] for c in cases.CLEANED])):
        assert got == want, (institution, text)


def test_every_institution_with_rules_has_a_case():
    assert set(BY_INSTITUTION) <= {c[0] for c in cases.CLEANED}


def test_rules_of_one_institution_leave_others_alone(spark):
    text = "Mål\nKontaktperson:\nLise Prøve\nForm"
    assert _clean(spark, [("uit", text), ("uia", text), (None, text)]) == ["Mål\n\nForm", text, text]


@pytest.mark.parametrize("year", ["1900", "2010-årene", "side 2024", "(2021)"])
def test_years_that_date_nothing_stay(spark, year):
    assert _clean(spark, [("other", f"Verk fra {year} leses")]) == [f"Verk fra {year} leses"]


def _steps(frame):
    return len(re.findall(r"regexp_replace\(", frame._jdf.queryExecution().optimizedPlan().toString()))


def test_each_rule_is_planned_once(spark):
    frame = spark.createDataFrame([(1, "x")], "k int, t string")
    assert _steps(frame.select(anonymize(F.lit("other"), F.col("t")).alias("p"))) == len(GENERAL) + 1
    rows = spark.createDataFrame([(1, "uia", "A", "A-1", 2020, "Vår", "x")], f"k int, institution_short string, {CODE} string, {RAW} string, `{YEAR}` int, {SEASON} string, course_plan string")
    once = _steps(rows.select(normalize_plan(F.col("course_plan")).alias("p")))
    hashed = plans.hashed(rows.withColumn("extracted_text", F.col("course_plan")))
    for out in (plans.plan_lookup(hashed, "k"), plans.plan_versions(hashed, "k"), plans.multi_version_codes(hashed)):
        assert _steps(out) == once
