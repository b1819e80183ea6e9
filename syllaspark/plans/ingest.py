"""The course table from the national registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import strip_version
from ..operators.columns import institution_of
from ..schema import CODE, RAW
from ..sources.registry_api import CHUNK, scan
from .registry import dimension

#: The registry's tables of programmes and of courses, and the programmes that are taken.
PROGRAMMES, COURSES_OF = "347", "208"
TAKEN = ("INTMASTER", "IMALU5-10", "IMALU1-7", "LUPE")

_PROGRAMME = "Studiumkode string, Studieprogramkode string"
_COURSE = "Institusjonskode string, Avdelingsnavn string, Studieprogramkode string, Emnekode string, Emnenavn string, `Årstall` int, Semesternavn string, Status int"


def ingest(spark: SparkSession, loader: Callable[[str, list[str]], list[dict]], taken: tuple[str, ...] = TAKEN, chunk: int = CHUNK) -> DataFrame:
    """Courses of all programmes of the kinds ``taken``, with institution, raw code and code.

    ``loader(table, keys)`` asks the registry.  The codes of the programmes (one for each
    programme in the country) come to the driver, as requests name them chunk by chunk.
    """
    kinds = scan(spark, loader, PROGRAMMES, list(taken), _PROGRAMME, chunk).where(F.col("Studiumkode").isin(*taken))
    codes = sorted(r[0] for r in kinds.select("Studieprogramkode").distinct().collect() if r[0] is not None)
    rows = institution_of(scan(spark, loader, COURSES_OF, codes, _COURSE, chunk), dimension(spark))
    first = ["institution_short", "Institusjonskode", "Avdelingsnavn", "Studieprogramkode"]
    return rows.withColumn(RAW, F.col("Emnekode")).withColumn(CODE, strip_version(F.col(RAW))).select(*first, RAW, CODE, *[c for c in rows.columns if c not in (*first, RAW, CODE)])
