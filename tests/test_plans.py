import pandas as pd
import pytest
from pyspark.sql import functions as F

from syllaspark.functions import text
from syllaspark.functions.diff import HELD_CHARS, compare, diff, in_parts
from syllaspark.operators import plans, reports
from syllaspark.schema import CODE, RAW, SEASON, YEAR

FRAME = f"institution_short string, {CODE} string, `{YEAR}` int, course_plan string, course_id string"


def _norm(spark, *texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r[0] for r in rows.orderBy("k").select(text.normalize_plan(F.col("t"))).collect()]


def test_normalize(spark):
    out = _norm(spark, None, "", "STUDENTEN Skal Lære", "KUNNSKAP om faget", "Kunnskap om faget", "  Mye   ekstra    mellomrom  ", "Emnekode ABC123 Studiepoeng 15 Emnets innhold Viktig tekst",
                "Course code ABC123 Number of credits 15 Course content Important", "Eksamensformer og vurdering", "Undervisning Vår og Høst og Haust", "Sommerkurs sommer og summer",
                "Utviklingen i Europa etter 1945 og finanskrisen i 2008", "Pensum 2020 om\u00a0bøker", "Pensum 2021 om bøker", "Learning outcome: x", "Learning outcomes: x")
    assert out[0] is None and out[1] is None
    assert out[2] == "studenten skal lære"
    assert out[3] == out[4] == "om faget"
    assert out[5] == "mye ekstra mellomrom"
    assert out[6] == "abc123 15 viktig tekst"
    assert out[7] == "abc123 15 important"
    assert out[8] == "vurderingsformer og vurdering"
    assert out[9] == "undervisning og og"
    assert out[10] == "sommerkurs og"
    assert "1945" not in out[11] and "2008" not in out[11]
    assert out[12] == out[13] == "om bøker"
    assert out[14] == out[15] == ": x"


def test_plan_id(spark):
    rows = spark.createDataFrame([("hello",), ("",), (None,)], "t string").select(text.plan_id(F.col("t")).alias("h")).collect()
    assert [r[0] for r in rows] == ["2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824", None, None]


def test_lookup_years(spark):
    rows = [("hivolda", "TEST101", y, p, f"c{y}") for y, p in ((2020, "Plan A"), (2021, "Plan A"), (2022, "Plan B"), (2023, "Plan B"))] + [("hivolda", "TEST102", 2020, None, "d")]
    found, courses = plans.deduplicate(spark.createDataFrame(rows, FRAME))
    got = sorted((r["year_from"], r["year_to"], r["course_plan"]) for r in found.collect())
    assert got == [(2020, 2021, "Plan A"), (2022, 2023, "Plan B")]
    assert courses.count() == 5 and courses.where("plan_content_id is null").count() == 1
    with pytest.raises(ValueError):
        plans.hashed(spark.createDataFrame([(1,)], "x int"))


def test_versions_pairs_and_summary(spark):
    rows = [("a", "X", "X-1", 2020 + k, "Høst", f"c{k}", t) for k, t in enumerate(["En. To.", "En. To.", "En. Tre.", None])]
    frame = spark.createDataFrame(rows, f"institution_short string, {CODE} string, {RAW} string, `{YEAR}` int, {SEASON} string, course_id string, extracted_text string")
    marked = plans.hashed(frame.withColumn("course_plan", F.col("extracted_text")))
    versions = plans.plan_versions(marked)
    assert [r["label"] for r in versions.orderBy("number").collect()] == ["V1 (2020-2021)", "V2 (2022)"]
    pair = plans.version_pairs(versions).first()
    assert (pair["old_label"], pair["new_label"], pair["same"]) == ("V1 (2020-2021)", "V2 (2022)", False)
    assert plans.multi_version_codes(marked).first()["versions"] == 2
    assert reports.dedup_by_institution(marked).first()["unique_plans"] == 3  # a missing plan counts
    quality = reports.quality(marked).first()
    assert (quality["rows"], quality["has_text"], quality["has_plan_id"], quality["unique_plans"], quality["years"]) == (4, 3, 3, 2, "2020-2023")
    report = reports.markdown(marked, plans.plan_lookup(marked))
    assert "| a | 4 | 1 | 2020-2023 | 3 | 75.0% |" in report and "**2**" in report


def test_quality_without_plans(spark):
    frame = spark.createDataFrame([("samas", "X-1", 2025, None, None)], f"institution_short string, {RAW} string, `{YEAR}` int, extracted_text string, plan_content_id string")
    row = reports.quality(frame).first()
    assert row["dedup_pct"] is None and row["median_chars"] is None and row["rate"] == 0


def test_diff(spark):
    ops = compare(["a", "b c d", "e"], ["a", "b x d", "e", "f"])
    assert [o["op"] for o in ops] == ["same", "changed", "same", "added"]
    assert [w["text"] for w in ops[1]["words"] if w["op"] != "same"] == ["c", "x"]
    rows = spark.createDataFrame([("En. To.", "En. Tre."), ("Lik.", "Lik."), (None, "x")], "a string, b string")
    out = [r[0] for r in rows.select(diff(F.col("a"), F.col("b"))).collect()]
    assert [o["op"] for o in out[0]] == ["same", "changed"] and out[1] == [] and out[2] is None


def test_differences_of_a_batch_in_parts(spark):
    lines = [f"line {k}." for k in range(HELD_CHARS // 20)]  # two such texts, less one line, are more than a part
    old, new = pd.Series([lines, None, ["a"], lines, ["a"], ["a"]]), pd.Series([lines[1:], ["a"], ["b"], lines[1:], None, ["a"]])
    parts = list(in_parts(iter([(old, new)]), 3, True))
    assert [len(p) for p in parts] == [1, 3, 2]
    assert [x for p in parts for x in p] == [None if x is None or y is None else compare(x, y) for x, y in zip(old, new)]
    rows = spark.createDataFrame([("\n".join(lines) if k % 3 else "En.", f"To {k}.") for k in range(20)], "a string, b string").coalesce(1)
    got = rows.select("a", "b", diff(F.col("a"), F.col("b")).alias("all"), diff(F.col("a"), F.col("b"), words=False).alias("lines")).collect()
    assert all(r["b"] in [o["new"] for o in r["all"]] for r in got)
    assert all([o["words"] for o in r["lines"]] == [None] * len(r["lines"]) and r["all"][0]["words"] for r in got)
    assert all([o[:3] for o in r["all"]] == [o[:3] for o in r["lines"]] for r in got)
