"""Whole harvests over recorded pages."""

import json

from pyspark.sql import functions as F

from syllaspark.operators.reports import validation_report
from syllaspark.plans import library
from syllaspark.plans.harvest import SUBJECTS, Harvester
from syllaspark.plans.ingest import ingest
from syllaspark.schema import CODE, COURSES, RAW, SEASON, YEAR
from syllaspark.sources import registry_api
from syllaspark.sources.fetch import fetch_with_checkpoint, recorded_transport
from syllaspark.sources.tables import course_html, read, read_light
from syllaspark.streaming.incremental import follow


def _courses(spark, *rows):
    fields = ("institution_short", RAW, CODE, YEAR, SEASON, "Status", "Emnenavn")
    frame = spark.createDataFrame([dict(zip(fields, r)) for r in rows], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in COURSES.fields if f.name in fields))
    return frame


PAGES = {
    "https://www.uia.no/studier/emner/2020/host/a1.html": "<div id=right-main><p>Plan A</p></div>",
    "https://www.uia.no/studier/emner/2021/host/a1.html": "<p>annet</p>",
    "https://www.ntnu.no/studier/emner/N1/2020": "Det finnes ingen informasjon for dette studieåret",
    "https://www.hivolda.no/emne/H1": '<a href="/emne/H1/5">2020 Haust</a>',
    "https://www.hivolda.no/emne/H1/5": "<article class=content-emweb>Plan H</article>",
    "https://www.uis.no/nb/student/course/S1_1": '<select id=fs-semester-select><option value="/nb/s">2020 - 2021</option><option value="https://d.no/old.pdf">2019 - 2020</option></select>',
    "https://www.uis.no/nb/s": '<div id=block-page-content><div class="link--">Plan S</div></div>',
    "https://d.no/old.pdf": "Gammel plan",
    "https://www.nla.no/for-studenter/Studie-%20og%20emneplaner/emneplan/L1/2020-2021": "<script>EmneplanPage(" + json.dumps({"props": {"items": {"2020-2021": {"title": "Plan L"}}}}) + ")</script>",
    SUBJECTS["Norsk"]: "<p>https://d.no/norsk.pdf</p>",
    "https://d.no/norsk.pdf": "Norsk 1, emne 1\nPlan T",
}


def test_strategies(spark, tmp_path):
    rows = _courses(
        spark,
        ("uia", "A1-1", "A1", 2020, "Høst", 1, "n"), ("uia", "A1-1", "A1", 2021, "Høst", 1, "n"), ("uia", "A2-1", "A2", 2020, "Høst", 1, "n"),
        ("ntnu", "N1-1", "N1", 2020, "Høst", 1, "n"), ("hivolda", "H1-1", "H1", 2020, "Høst", 1, "n"), ("hivolda", "H1-1", "H1", 2021, "Høst", 1, "n"),
        ("uis", "S1-1", "S1", 2020, "Høst", 1, "n"), ("uis", "S1-1", "S1", 2019, "Høst", 1, "n"),
        ("nla", "L1-1", "L1", 2020, "Høst", 1, "n"), ("nla", "L1-1", "L1", 2019, "Høst", 1, "n"),
        ("steiner", "T1-1", "T1", 2020, "Høst", 1, "Norsk 1, emne 1"), ("samas", "M1-1", "M1", 2020, "Høst", 1, "n"),
        ("usn", "U1-1", "U1", 2020, "Høst", 1, "n"),
    )
    browser = lambda own: own.select("course_id", CODE, YEAR, SEASON, F.lit(1).alias("version"), F.lit("U1 Undervisningsstart høst 2020\nPlan U").alias("content"))
    h = Harvester(spark, str(tmp_path / "cp"), recorded_transport(PAGES), lambda data: data.decode().split("|"), browser)
    text = lambda name: {(r[RAW], r[YEAR]): r["extracted_text"] for r in h.harvest(rows, name).collect()}
    assert text("uia") == {("A1-1", 2020): "Plan A", ("A1-1", 2021): None, ("A2-1", 2020): None}
    failed = {r["course_id"]: r["html_error"] for r in h.harvest(rows, "uia").where("not html_success").collect()}
    assert list(failed) == ["uia_A2-1_2020_autumn_1"] and failed["uia_A2-1_2020_autumn_1"]["class"] == "KeyError"
    assert h.harvest(rows, "ntnu").first()["html_error"]["class"] == "ntnu_no_info_error"
    assert text("hivolda") == {("H1-1", 2020): "Plan H", ("H1-1", 2021): None}
    got = {(r[RAW], r[YEAR]): (r["extracted_text"], r["url"]) for r in h.harvest(rows, "uis").collect()}
    assert got == {("S1-1", 2020): ("Plan S", "https://www.uis.no/nb/s"), ("S1-1", 2019): ("Gammel plan", "https://d.no/old.pdf")}
    assert text("nla") == {("L1-1", 2020): "Plan L"}  # no year in its addresses: the latest alone
    assert text("steiner") == {("T1-1", 2020): "Norsk 1, emne 1\nPlan T"}
    assert text("samas") == {("M1-1", 2020): None}
    usn = h.harvest(rows, "usn").first()
    assert usn["url_version"] == 1 and usn["extracted_text"].endswith("Plan U") and usn["url"].endswith("#/emne/U1_1_2020_HØST")

    out = str(tmp_path / "out")
    counts = h.harvest_all(rows, out, names=["uia", "samas", "nowhere"])
    assert counts["uia"]["rows"] == 3 and counts["uia"]["texts"] == 1 and list(h.errors) == ["nowhere"]
    h.harvest_all(rows, out, year=2021, names=["uia"])  # replaces one year, keeps the other
    assert read(spark, out).where("institution_short = 'uia'").count() == 3
    assert "html" not in read_light(spark, out).columns
    assert "Plan A" in course_html(spark, out, "uia", "uia_A1-1_2020_autumn_1").first()["html"]
    plans, courses = library.build(spark, out, str(tmp_path / "courses"), str(tmp_path / "plans"))
    assert plans.count() == 1 and courses.count() == 4
    assert library.course_list(courses, institutions=["uia"], with_text=True).first()["Institution"] == "UiA"


def test_checkpoint_fetches_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x://1", "uia"), ("b", "x://2", "uia"), ("c", None, "uia")], "course_id string, url string, institution_short string")
    path = str(tmp_path / "cp")
    first = {r["course_id"]: r["html"] for r in fetch_with_checkpoint(spark, rows, path, recorded_transport({"x://1": "one"})).collect()}
    assert first == {"a": "one", "b": None, "c": None}
    again = {r["course_id"]: r["html"] for r in fetch_with_checkpoint(spark, rows, path, recorded_transport({"x://1": "new", "x://2": "two"})).collect()}
    assert again == first  # failures are kept too
    tried = {r["course_id"]: r["html"] for r in fetch_with_checkpoint(spark, rows, path, recorded_transport({"x://2": "two"}), retry_failed=True).collect()}
    assert tried == {"a": "one", "b": "two", "c": None}
    fresh = {r["course_id"]: r["html"] for r in fetch_with_checkpoint(spark, rows, path, recorded_transport({"x://1": "new"}), refetch=True).collect()}
    assert fresh == {"a": "new", "b": None, "c": None}


def test_registry_scan_in_chunks(spark):
    raw, year = RAW, YEAR

    def load(table, keys):
        return [{raw: k, year: len(keys)} for k in keys]

    got = registry_api.scan(spark, load, "courses", [f"K{i}" for i in range(170)])
    assert got.count() == 170
    assert {r[0] for r in got.select(YEAR).distinct().collect()} == {80, 10}


def test_stream_adds_each_course_once(spark, tmp_path):
    fields = f"course_id string, institution_short string, {CODE} string, `{YEAR}` int, extracted_text string"
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    one = spark.createDataFrame([("a", "uia", "A", 2020, "Plan")], fields)
    one.write.mode("append").parquet(src)
    follow(spark, src, one.schema, out, state).awaitTermination()
    spark.createDataFrame([("a", "uia", "A", 2020, "Plan"), ("b", "uia", "A", 2021, None)], fields).write.mode("append").parquet(src)
    follow(spark, src, one.schema, out, state).awaitTermination()
    assert sorted(r["course_id"] for r in read(spark, out).collect()) == ["a", "b"]


def test_version_diffs(spark):
    rows = [("c1", "a", "X", "X-1", 2020, "Høst", "En. To."), ("c2", "a", "X", "X-1", 2021, "Høst", "En. Tre.")]
    frame = spark.createDataFrame(rows, f"course_id string, institution_short string, {CODE} string, {RAW} string, `{YEAR}` int, {SEASON} string, extracted_text string")
    from syllaspark.operators.plans import clean, hashed

    marked = hashed(clean(frame))
    assert [r[0] for r in library.codes_with_versions(marked, "a").collect()] == ["X-1"]
    assert [o["op"] for o in library.version_diffs(marked, "a", "X-1", normalized=False).first()["changes"]] == ["same", "changed"]


def test_ingest(spark):
    def loader(table, keys):
        if table == "347":
            return [{"Studiumkode": k, "Studieprogramkode": p} for k, p in (("LUPE", "P1"), ("LUPE", "P2"), ("INTMASTER", "P3"), ("ANNET", "P4")) if k in keys or k == "ANNET"]
        return [{"Institusjonskode": "1171" if p == "P1" else "0", "Studieprogramkode": p, "Emnekode": f"{p}A-1", "Emnenavn": "n", YEAR: 2020, SEASON: "Høst", "Status": 1} for p in keys]

    rows = ingest(spark, loader, chunk=2).orderBy(RAW).collect()
    assert [(r[RAW], r[CODE], r[YEAR]) for r in rows] == [("P1A-1", "P1A", 2020), ("P2A-1", "P2A", 2020), ("P3A-1", "P3A", 2020)]
    assert rows[0].asDict().keys() >= {"institution_short", "Emnenavn", SEASON, "Status"} and rows[1]["institution_short"] is None


def test_validation_report(spark):
    fields = f"{RAW} string, `{YEAR}` int, url string, html string, html_success boolean, html_error struct<class:string,message:string>, extracted_text string"
    rows = spark.createDataFrame([("B-1", 2021, "u", "<p>b-1</p>", True, None, "tekst"), ("A-1", 2020, "v", None, False, ("E", "borte"), None), ("C-1", 2020, None, None, None, None, None)], fields)
    assert [r["value"] for r in validation_report(rows, "Prøve").collect()] == [
        "Prøve", "Rows: 3", "Fetched: 1", "With text: 1", "Mean length: 5",
        "A-1 (2020)", "  URL: v", "  Fetch: FAILED", "  Error: borte",
        "B-1 (2021)", "  URL: u", "  Fetch: OK", "  Course code found", "  Text: 5 chars",
        "C-1 (2020)", "  URL: NA", "  Fetch: FAILED", "  Error: no url",
    ]
