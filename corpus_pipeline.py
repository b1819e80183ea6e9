"""A training corpus from raw documents: five stages, each one operator.

Every stage but the last returns the columns of ``documents``.  Stages that drop
rows list what they drop and leave those rows out where they stand, so that kept
texts need not move.  Rows are named by id and text, as ids may repeat.
"""

from __future__ import annotations

from itertools import count

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syllaspark.llm import langid, mixing
from syllaspark.llm.bpe import bpe_encode
from syllaspark.llm.jaccard import near_groups
from syllaspark.llm.recipes import exact_groups
from syllaspark.session import Scratch

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: A document stays if its language is this probable; below, no language is more likely than the others together.
LEAST_SCORE = 0.5
#: Up to so many dropped rows are broadcast; more are left out by a shuffled join.
BROADCAST_ROWS = 500_000


def _row(docs: DataFrame) -> Column:
    return F.struct(docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("hash"))


def _without(docs: DataFrame, dropped: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` less the rows that ``dropped`` names by (id, hash), or by id alone."""
    dropped = scratch.save(dropped.distinct(), "dropped")
    gone = dropped.select(*[F.col(c).alias(f"gone_{c}") for c in dropped.columns])
    if dropped.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = docs["doc_id"].eqNullSafe(gone["gone_id"])
    if "hash" in dropped.columns:
        same = same & (F.xxhash64(docs["text"]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without one language that outweighs the others, go."""
    model = langid.learn(docs.where(~langid.held_out(docs["doc_id"])), RANKS)
    named = docs.select(_row(docs).alias("row"), docs["text"])
    found = langid.identify(named, model, id_col="row")
    bad = found.where((F.col("lang_pred") == langid.UND) | (F.col("score") < LEAST_SCORE)) if model else found.where("false")
    return _without(docs, bad.select("row.*"), Scratch(spark, "language"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts stays."""
    scratch = Scratch(spark, "exact")
    groups = scratch.save(exact_groups(docs.select(_row(docs).alias("row"), docs["text"]), id_col="row"), "groups")
    kept = _without(docs, groups.where("not kept").select("row.*"), scratch)
    again = scratch.save(groups.where("kept").groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row.*"), "again")
    if not again.limit(1).collect():
        return kept
    twice = kept.join(again.select("id", F.col("hash").alias("again_hash")), kept["doc_id"].eqNullSafe(F.col("id")) & (F.xxhash64(kept["text"]) == F.col("again_hash")), "left_semi")
    return _without(kept, again, scratch).unionByName(twice.dropDuplicates(["doc_id", "text"]))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles at 0.8 connect, the least id stays; of its rows, where it repeats, one.

    Null and empty texts have no shingle and stay, and so do rows without an id, which
    can't be grouped.  An empty table stays empty.
    """
    scratch = Scratch(spark, "near")
    known = docs.where("doc_id is not null")
    if not known.groupBy("doc_id").count().where("count > 1").limit(1).collect():
        groups = near_groups(docs, width=5, num=80, den=100)
        return _without(docs, groups.where("component_id <> doc_id").select(F.col("doc_id").alias("id")), scratch)
    rows = scratch.save(known.select(_row(known).alias("row")).distinct(), "rows")
    # a key of its own for each row: the first salt under which no two of them share one
    salt = next(k for k in count() if not rows.groupBy(F.xxhash64("row.id", "row.hash", F.lit(k))).count().where("count > 1").limit(1).collect())
    key = lambda row: F.xxhash64(row["id"], row["hash"], F.lit(salt))
    groups = near_groups(known.select(key(_row(known)).alias("key"), known["text"]), width=5, num=80, den=100, id_col="key")
    linked = scratch.save(groups.where("component_id <> key").select("key", "component_id"), "linked")
    members = linked.unionByName(linked.select(F.col("component_id").alias("key"), "component_id").distinct())
    members = scratch.save(members.join(rows.select(key(F.col("row")).alias("key"), "row"), "key").select("component_id", "row"), "members")
    least = members.groupBy("component_id").agg(F.min("row").alias("row"))
    return _without(docs, members.join(least.select("row"), "row", "left_anti").select("row.*"), scratch)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at temperature weights: every document is taken, those of small sources up to four times.

    A null source is a source of its own; a source without words is taken once.  Repeated
    rows are each taken.  An empty table stays empty.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture, and what they decode to, as digests.

    One row for each row, also of null and empty texts, which have no ids.
    """
    return bpe_encode(docs, RANKS, public_tokenizers.PATTERN, digests=True)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

#: SQL expresses neither the language model nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it; then what only it needed is deleted."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        since = len(Scratch.made)
        docs, before = scratch.save(stage(spark, docs, sf_dir), name), docs
        Scratch.release(since)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
