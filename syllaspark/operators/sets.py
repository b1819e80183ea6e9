"""Set operations and sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bind_rows(*tables: DataFrame) -> DataFrame:
    """All rows, columns matched by name; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def stack(*tables: DataFrame) -> DataFrame:
    """All rows of tables with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def only_left(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def key_diagnostics(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: keys in both tables, in the first alone and in the second alone."""
    sides = a.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(b.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    seen = sides.groupBy(key).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return seen.agg(F.count_if(F.expr("_a = 1 and _b = 1")).alias("matched"), F.count_if(F.expr("_b = 0")).alias("only_left"), F.count_if(F.expr("_a = 0")).alias("only_right"))


def stratified(rows: DataFrame, strata: list[str], key: Column, each: int = 2, most: int = 20, seed: int = 42) -> DataFrame:
    """At most ``each`` rows of every stratum and ``most`` in all, by a digest of key and seed.

    The same rows are drawn on any cluster; no generator's state is involved.
    """
    digest = F.sha2(F.concat(key.cast("string"), F.lit(str(seed))), 256)
    ranked = rows.withColumn("_digest", digest).withColumn("_n", F.row_number().over(Window.partitionBy(*strata).orderBy("_digest")))
    return ranked.where(F.col("_n") <= each).orderBy("_digest").limit(most).drop("_digest", "_n")


def chunk_of(number: Column, size: int = 80) -> Column:
    """The chunk of a row number that counts from 0."""
    return F.floor(number / size).cast("long")
