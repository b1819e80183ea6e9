"""Names and types of the course tables, stage by stage."""

from __future__ import annotations

from pyspark.sql import types as T

YEAR, SEASON, CODE, RAW = "Årstall", "Semesternavn", "Emnekode", "Emnekode_raw"

#: The registry's columns, in its order.
_STRINGS = "institution_short,Institusjonskode,Institusjonsnavn,Avdelingskode,Avdelingsnavn,Avdelingskode_SSB"
COURSES = T.StructType(
    [T.StructField(n, T.StringType()) for n in _STRINGS.split(",")]
    + [T.StructField(YEAR, T.IntegerType()), T.StructField("Semester", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in (SEASON, "Studieprogramkode", "Studieprogramnavn", RAW, CODE, "Emnenavn", "Nivåkode", "Nivånavn")]
    + [T.StructField("Studiepoeng", T.DoubleType()), T.StructField("NUS-kode", T.StringType()), T.StructField("Status", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("Statusnavn", "Underv.språk", "Navn", "Fagkode", "Fagnavn")]
    + [T.StructField("Oppgave (ny fra h2012)", T.IntegerType())]
)
ERROR = T.StructType([T.StructField("class", T.StringType()), T.StructField("message", T.StringType())])
#: What a harvest adds.
HARVESTED = T.StructType([T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("html_error", ERROR), T.StructField("html_success", T.BooleanType()), T.StructField("extracted_text", T.StringType())])
#: What cleaning and hashing add.
PLANNED = T.StructType([T.StructField(n, T.StringType()) for n in ("course_plan", "course_plan_normalized", "plan_content_id")])
CHECKPOINT = T.StructType([T.StructField("course_id", T.StringType()), *HARVESTED.fields[1:4]])
DISCOVERY = T.StructType([T.StructField("label", T.StringType()), T.StructField("url", T.StringType()), T.StructField("type", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField(RAW, T.StringType())])
