"""Fetching pages and documents through a pluggable transport, once and resumably.

A transport is a callable ``(url, user_agent) -> bytes``; it raises on failure.  It
runs on the executors, so a real one opens its client once per task.  Fetched rows
are written before anything reads them: no later step fetches again.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import soft_404
from ..operators.filters import present
from ..operators.joins import keep_first, todo
from ..session import ship
from .tables import append, exists, read, remove

Transport = Callable[[str, str], bytes]
#: User agents by the registry's setting.
AGENTS = {"project": "syllaspark/0.1 (course-plan research)", "browser": "Mozilla/5.0 (X11; Linux x86_64; rv:128.0) Gecko/20100101 Firefox/128.0"}


def http_transport(timeout: float = 30.0) -> Transport:
    """Plain HTTP by the standard library."""

    def get(url: str, agent: str) -> bytes:
        from urllib.request import Request, urlopen

        with urlopen(Request(url, headers={"User-Agent": agent}), timeout=timeout) as answer:
            return answer.read()

    return get


def recorded_transport(pages: dict[str, bytes | str]) -> Transport:
    """Pages from a dictionary; others fail.  For tests and replays."""

    def get(url: str, agent: str) -> bytes:
        page = pages[url]
        return page.encode() if isinstance(page, str) else page

    return get


def fetch(requests: DataFrame, transport: Transport, key: str = "course_id", agent: str = "project", tasks: int = 64) -> DataFrame:
    """(key, body, html_error, html_success) for rows with an address.

    Rows are dealt out by host and a part of the address, so that a host is met by
    few tasks and a large one still by several.  Each failure stays in its row.
    """
    ship(requests.sparkSession)
    kind = requests.schema[key].dataType
    error = T.StructType([T.StructField("class", T.StringType()), T.StructField("message", T.StringType())])
    schema = T.StructType([T.StructField(key, kind), T.StructField("body", T.BinaryType()), T.StructField("html_error", error), T.StructField("html_success", T.BooleanType())])
    sent = AGENTS[agent]

    def run(batches):
        for batch in batches:
            bodies, errors, good = [], [], []
            for url in batch.column(1).to_pylist():
                try:
                    if not urlsplit(url).scheme:
                        raise ValueError("not an address")
                    bodies.append(transport(url, sent))
                    errors.append(None)
                    good.append(True)
                except Exception as e:
                    bodies.append(None)
                    errors.append({"class": type(e).__name__, "message": str(e)})
                    good.append(False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary()), pa.array(errors, pa.struct([("class", pa.string()), ("message", pa.string())])), pa.array(good, pa.bool_())], names=[key, "body", "html_error", "html_success"])

    asked = requests.where(present(F.col("url"))).select(key, "url")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    return asked.repartition(tasks, host, F.pmod(F.xxhash64("url"), F.lit(4))).mapInArrow(run, schema)


def fetch_html(courses: DataFrame, transport: Transport, agent: str = "project") -> DataFrame:
    """(course_id, html, html_error, html_success), with pages that only look found turned into errors."""
    got = fetch(courses, transport, agent=agent).join(courses.select("course_id", "institution_short").dropDuplicates(["course_id"]), "course_id")
    html = F.decode("body", "UTF-8")
    lost = soft_404(F.col("institution_short"), html)
    return got.select(
        "course_id",
        F.when(lost.isNull(), html).alias("html"),
        F.when(lost.isNotNull(), F.struct(lost.alias("class"), F.lit("the page says that there is nothing").alias("message"))).otherwise(F.col("html_error")).alias("html_error"),
        F.when(lost.isNotNull(), F.lit(False)).otherwise(F.col("html_success")).alias("html_success"),
    )


def fetch_with_checkpoint(spark: SparkSession, courses: DataFrame, path: str, transport: Transport, agent: str = "project", refetch: bool = False, retry_failed: bool = False) -> DataFrame:
    """Courses with html, html_error and html_success, fetching only what the checkpoint at ``path`` lacks.

    Failures are stored too and by default not tried again.  ``refetch`` starts
    afresh.  New rows are appended; the first result of a course counts, successes
    before failures.
    """
    if refetch:
        remove(spark, path)
    wanted = courses
    if exists(spark, path):
        done = read(spark, path)
        wanted = todo(courses, done.where("html_success") if retry_failed else done)
    once = keep_first(wanted.where(present(F.col("url"))).select("course_id", "url", "institution_short"), ["course_id"], [F.col("url")])
    append(fetch_html(once, transport, agent), path)
    done = read(spark, path)
    first = keep_first(done, ["course_id"], [~F.coalesce(F.col("html_success"), F.lit(False)), F.col("html")])
    return courses.drop("html", "html_error", "html_success").join(first, "course_id", "left")
