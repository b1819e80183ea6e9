"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from syllaspark import queries as base

FOLDER = os.environ.get("SYLLASPARK_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


def _rows(frame, columns):
    show = lambda v: "-" if v is None or (not hasattr(v, "__len__") and pd.isna(v)) else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(show, r)) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(base.ORACLES))
def test_matches_sql(spark, duck, name):
    got, want = base.QUERIES[name](spark, FOLDER).toPandas(), duck.execute(base.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert _rows(got, columns) == _rows(want, columns)


@pytest.mark.parametrize("name", sorted(set(base.QUERIES) - set(base.ORACLES)))
def test_runs(spark, name):
    assert base.QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and {"plan_content_id", "year_from", "year_to"} <= set(out.columns)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scans_prune_and_push_down(spark):
    plan = base.browse_filter(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "ReadSchema" in plan
    keys = base.course_key(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in keys.split("ReadSchema:")[1].split("\n")[0]


def test_every_text_counts_without_a_twin(spark, tmp_path):
    rows = [(9, "one plan", "en", "s", 7), (18, "another plan", "en", "s", 7), (27, None, "en", "s", 7), (1, "third", "de", "s", 7)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    cleaned = {x["doc_id"]: x["course_plan"] for x in base.anonymize_institutions(spark, str(tmp_path)).collect()}
    assert {k for k, t in cleaned.items() if t} == {1, 9, 18} and cleaned[27] is None
    assert [(x["institution_short"], x["number"]) for x in base.text_diff(spark, str(tmp_path)).collect()] == [("en", 2)]


def test_text_diff_moves_what_it_reads(spark):
    plan = base.text_diff(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min_by(extracted_text") == 1 and "min_by(course_plan_normalized" not in plan
