import pytest
from pyspark.sql import functions as F

from syllaspark.functions import keys
from syllaspark.operators import columns, filters, joins, sets
from syllaspark.plans.registry import INSTITUTIONS, institution
from syllaspark.schema import CODE, RAW, SEASON, YEAR

FRAME = f"institution_short string, {RAW} string, {CODE} string, `{YEAR}` int, {SEASON} string, Status int, Avdelingsnavn string"
URLS = [
    ("ntnu", "abC1-1", "abC1", 2020, "Vår", "https://www.ntnu.no/studier/emner/ABC1/2020"),
    ("uia", "A1-1", "A1", 2020, "Høst", "https://www.uia.no/studier/emner/2020/host/a1.html"),
    ("uia", "A1-1", "A1", 2020, "Sommer", "https://www.uia.no/studier/emner/2020/sommer/a1.html"),
    ("uib", "A1-1", "A1", 2020, "Vår", "https://www4.uib.no/studier/emner/a1?start_semester=2020V"),
    ("uib", "A1-1", "A1", 2020, "Sommer", "https://www4.uib.no/studier/emner/a1?start_semester=2020H"),
    ("nord", "A1-1", "A1", 2020, "Vår", "https://www.nord.no/studier/emner/a1?year=2020&semester=V%C3%85R"),
    ("nord", "A1-1", "A1", 2020, "Høst", "https://www.nord.no/studier/emner/a1?year=2020&semester=H%C3%98ST"),
    ("hvl", "Ab1-1", "Ab1", 2020, "Vår", "https://www.hvl.no/studier/studieprogram/emne/2020/Ab1"),
    ("hiof", "A1-1", "A1", 2020, "Høst", "https://www.hiof.no/studier/emner/historiske-emner/lu/2020/host/a1.html"),
    ("hiof", "A1-1", "A1", 2021, "Vår", "https://www.hiof.no/studier/emner/historiske-emner/lu/2021/var/a1.html"),
    ("hiof", "A1-1", "A1", 2021, "Høst", "https://www.hiof.no/studier/emner/lusp/lusp/2021/host/a1.html"),
    ("oslomet", "a1-1", "a1", 2020, "Vår", "https://student.oslomet.no/studier/-/studieinfo/emne/A1/2020/HØST"),
    ("inn", "A1-1", "A1", 2021, "Høst", None),
    ("inn", "A1-1", "A1", 2022, "Høst", "https://studiekatalog.edutorium.no/inn/nb/emne/A1/2022-host"),
    ("mf", "A1-1", "A1", 2022, "Høst", "https://mf.no/studier/emner/a1"),
    ("nla", "A1-1", "A1", 2024, "Vår", "https://www.nla.no/for-studenter/Studie-%20og%20emneplaner/emneplan/A1/2023-2024"),
    ("nla", "A1-1", "A1", 2023, "Høst", "https://www.nla.no/for-studenter/Studie-%20og%20emneplaner/emneplan/A1/2023-2024"),
    ("nih", "A1-1", "A1", 2023, "Vår", "https://www.nih.no/studier/emner/2023/var/a1.html"),
    ("uis", "by-G1-1", "by-G1", 2023, "Vår", "https://www.uis.no/nb/student/course/BY_G1_1"),
    ("nmbu", "a1-1", "a1", 2023, "Vår", "https://www.nmbu.no/emne/A1"),
    *[(i, "A1-1", "A1", 2023, "Vår", None) for i in ("hivolda", "usn", "uit", "samas", "steiner")],
]


def test_urls(spark):
    rows = [(*u[:5], 1, None) for u in URLS] + [("uio", "a1-1", "a1", 2023, "Vår", 1, "Fysisk institutt"), ("uio", "a1-1", "a1", 2023, "Vår", 1, "Ukjent")]
    got = [r["url"] for r in columns.with_url(spark.createDataFrame(rows, FRAME)).collect()]
    assert got == [u[5] for u in URLS] + ["https://www.uio.no/studier/emner/matnat/fys/A1/", None]


def test_course_id_spells_out_missing_parts(spark):
    frame = columns.with_course_id(spark.createDataFrame([("nla", "A-1", "A", 2023, "Høst", None, None), (None, "B", "B", None, "Januar", 2, None)], FRAME))
    assert frame.columns[0] == "course_id"
    assert [r[0] for r in frame.collect()] == ["nla_A-1_2023_autumn_NA", "NA_B_NA_Januar_2"]


def test_scalars(spark):
    frame = spark.createDataFrame([("A-1", 2023, "Høst"), ("A_B.12", 2024, "Vår"), ("A", 2024, "Sommer")], "c string, y int, s string")
    got = frame.select(keys.strip_version(F.col("c")), keys.academic_year(F.col("y"), F.col("s")), keys.season_slug(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [("A", "2023-2024", "host"), ("A_B", "2023-2024", "var"), ("A", None, "sommer")]
    links = spark.createDataFrame([("2024 Haust",), (" 2023 vår",), ("none",)], "t string").select(*keys.link_term(F.col("t"))).collect()
    assert [tuple(r) for r in links] == [(2024, "Høst"), (2023, "Vår"), (None, None)]
    options = spark.createDataFrame([("ABC: H 2023",), ("x: V 2020",), ("x",)], "t string").select(*keys.option_term(F.col("t"))).collect()
    assert [tuple(r) for r in options] == [(2023, "Høst"), (2020, "Vår"), (None, None)]


def test_validation(spark):
    frame = spark.createDataFrame([("a",)], "institution_short string")
    with pytest.raises(ValueError, match=CODE):
        columns.validate(frame)
    with pytest.raises(ValueError):
        columns.validate(frame, "nonsense")
    assert {"url", "html", "html_error", "html_success", "extracted_text"} <= set(columns.ensure_output(frame).columns)
    with pytest.raises(ValueError):
        institution("nowhere")
    assert len(INSTITUTIONS) == 19


def test_year_filter(spark):
    frame = spark.createDataFrame([("a", 2020), ("a", 2021), ("b", 2019), (None, 2000)], f"institution_short string, `{YEAR}` int")
    years = lambda f: sorted(r[1] for r in f.collect())
    assert years(filters.year_filter(frame, False, 2020)) == [2020]
    assert years(filters.year_filter(frame, True)) == [2000, 2019, 2020, 2021]
    assert years(filters.year_filter(frame, False)) == [2021]
    assert years(filters.latest_year(frame)) == years(filters.latest_year_by_window(frame))[1:] == [2019, 2021]


def test_update_overwrites_with_null(spark):
    rows = spark.createDataFrame([("a", "old", 1), ("b", "old", 2), ("c", "old", 3)], "course_id string, url string, n int")
    new = spark.createDataFrame([("a", "new"), ("b", None), ("z", "other")], "course_id string, url string")
    got = {r["course_id"]: (r["url"], r["n"]) for r in joins.update_rows(rows, new).collect()}
    assert got == {"a": ("new", 1), "b": (None, 2), "c": ("old", 3)}


def test_checkpoint_joins(spark):
    rows = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", None), ("d", "")], "course_id string, url string")
    done = spark.createDataFrame([("a", "second", True, 2), ("a", "first", True, 1), ("z", None, False, 1)], "course_id string, html string, html_success boolean, fetched_at int").withColumn("html_error", F.lit(None).cast("struct<class:string,message:string>"))
    assert [r[0] for r in joins.todo(rows, done).select("course_id").collect()] == ["b"]
    got = {r["course_id"]: r["html"] for r in joins.merge_checkpoint(rows, done, [F.col("fetched_at")]).collect()}
    assert got == {"a": "first", "b": None, "c": None, "d": None}


def test_discovery_keeps_one_row_per_course(spark):
    rows = spark.createDataFrame([("1", "A", 2020, "base"), ("2", "A", 2021, "base"), ("3", "B", 2020, None)], f"course_id string, {RAW} string, `{YEAR}` int, url string")
    found = spark.createDataFrame([("A", 2020, "p", "pdf"), ("A", 2020, "h", "html"), ("A", None, "x", "html")], f"{RAW} string, year int, url string, type string")
    got = {r["course_id"]: (r["url"], r["route"], r["url_matched"]) for r in joins.match_discovery(rows, found).collect()}
    assert got == {"1": ("h", "html", True), "2": ("base", "html", False), "3": (None, "none", False)}


def test_sets_and_samples(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(2, 0.5), (3, 1.0)], "k int, b double")
    assert sets.bind_rows(a, b).count() == 4 and sets.common_columns(a, b) == ["k"]
    assert tuple(sets.key_diagnostics(a, b, "k").first()) == (1, 1, 1)
    many = spark.range(100).withColumn("g", F.col("id") % 4)
    first = [r["id"] for r in sets.stratified(many, ["g"], F.col("id"), 2, 7).collect()]
    assert len(first) == 7 and first == [r["id"] for r in sets.stratified(many.repartition(3), ["g"], F.col("id"), 2, 7).collect()]


def test_display(spark):
    frame = spark.createDataFrame([("nla", "A", "Navn", 2020, "Vår", 4, "x", 'u?a=1&b="2"'), ("zz", "A", "Navn", 2020, "Vår", 9, None, None)], f"institution_short string, {RAW} string, Emnenavn string, `{YEAR}` int, {SEASON} string, Status int, extracted_text string, url string")
    got = columns.display(frame).collect()
    assert (got[0]["Institution"], got[0]["Status"], got[0]["Text"]) == ("NLA", "Disc. w/ exam", "Yes")
    assert 'href="u?a=1&amp;b=&quot;2&quot;"' in got[0]["URL"] and got[1]["URL"] == "" and got[1]["Institution"] is None
