"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

A normalised text is cut where its own content says so, so that equal texts have
equal chunks.  Every distinct chunk moves once, to prove that its identifier stands
for one chunk only; from then on a document is the ordered list of its chunks'
identifiers, and only such lists are compared.

Rows: one output row per input row.  A null text counts as empty, and all empty
texts are equal.  Repeated ids each have their row.  A null id takes part and loses
ties.  Columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

#: A chunk ends after this expression, once it has the least length, or at the greatest length.
CUT, LEAST, MOST = "[aeio][nrst]", 900, 4000


def squeezed(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def chunks(text: Column) -> Column:
    """Content-defined chunks, in order; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{LEAST},{MOST}}}?(?:{CUT})|.{{1,{MOST}}}"), F.lit(0))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row.

    Of equal texts the one with the most code points stays, then the smallest id.
    Rows that share the id of the row that stays are all marked as kept.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "recipes")
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    cut = plain.select("id", F.length(F.coalesce("text", F.lit(""))).alias("size"), squeezed(F.col("text")).alias("norm")).withColumn("chunks", chunks(F.col("norm")))
    mark = lambda c: F.xxhash64(c)

    # one row for each distinct chunk and identifier, then identifiers that stand for several chunks
    distinct = cut.select(F.explode("chunks").alias("chunk")).groupBy(mark(F.col("chunk")).alias("mark"), "chunk").agg(F.count("*").alias("n"))
    clashes = scratch.save(distinct.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"), "clashes")

    recipes = cut.select("id", "size", F.sha2(F.col("norm"), 256).alias("sha"), F.transform("chunks", mark).alias("recipe"))
    if clashes.limit(1).collect():  # give the chunks of a shared identifier numbers of their own
        numbered = _numbered(cut, clashes)
        recipes = recipes.join(numbered, "sha", "left").withColumn("recipe", F.coalesce("exact", "recipe")).drop("exact")
    recipes = scratch.save(recipes.withColumn("key", F.sha2(F.array_join(F.transform("recipe", lambda m: m.cast("string")), ","), 256)), "recipes")

    best = F.min(F.struct((-F.col("size")).alias("less"), F.col("id").isNull().alias("none"), F.col("id").alias("id")))
    groups = scratch.save(recipes.groupBy("recipe").agg(best.alias("best"), F.count("*").alias("n"), F.first("key").alias("key")).select("key", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size")), "groups")
    scratch.keep(recipes, groups)
    return recipes.join(groups, "key").select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def _numbered(cut: DataFrame, clashes: DataFrame) -> DataFrame:
    """(sha, exact): for texts with a clashing identifier, lists in which equal entries mean equal chunks."""
    own = cut.select(F.sha2(F.col("norm"), 256).alias("sha"), F.posexplode("chunks").alias("at", "chunk")).withColumn("mark", F.xxhash64("chunk"))
    hit = own.join(clashes, "mark", "left_semi").select("sha").distinct()
    rows = own.join(hit, "sha", "left_semi").withColumn("digest", F.conv(F.substring(F.sha2(F.col("chunk"), 256), 1, 15), 16, 10).cast("long"))
    return rows.groupBy("sha").agg(F.transform(F.array_sort(F.collect_set(F.struct("at", "digest"))), lambda x: x["digest"]).alias("exact"))
