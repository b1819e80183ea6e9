"""The corpus pipeline: each stage by brute force on its own input."""

import random

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from syllaspark.llm import bpe

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark):
    r = random.Random(1)
    base = [" ".join(r.choice(["the", "of", "and", "that", "with"]) + r.choice(["", "ing", "ed", "s"]) + r.choice("abcdefgh") for _ in range(60)) for _ in range(40)]
    rows = [(k, t, "en", f"s{k % 3 and 1}") for k, t in enumerate(base)]
    rows += [(100, base[0].replace(" ", "\n"), "en", "s1"), (101, base[1], "en", "s0"), (102, base[2] + " tail", "en", "s1"), (103, base[3], "en", "s1"), (103, base[3], "en", "s1")]
    rows += [(110, None, "en", "s0"), (111, "", "en", None), (112, "123 -- 456", "en", "s0"), (113, base[4].rsplit(" ", 1)[0], None, None), (None, base[5] + " x", "en", "s1")]
    return spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], FIELDS)


def _run(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, "")


def test_stages(spark, tmp_path):
    docs = _docs(spark)
    kept = _run(spark, "language", docs)
    assert kept.columns == docs.columns
    gone = {x["doc_id"] for x in docs.collect()} - {x["doc_id"] for x in kept.collect()}
    assert gone == {110, 111, 112}
    once = _run(spark, "exact", kept)
    left = sorted(x["doc_id"] for x in once.where("doc_id is not null").collect())
    assert left == [*range(40), 102, 113] and once.columns == docs.columns
    near = _run(spark, "near", once)
    assert sorted(x["doc_id"] for x in near.where("doc_id is not null").collect()) == list(range(40))
    assert near.where("doc_id is null").count() == 1  # without an id it can't be grouped, and stays
    mixed = _run(spark, "mix", near)
    assert {x["doc_id"] for x in mixed.collect()} == {x["doc_id"] for x in near.collect()} and mixed.columns == docs.columns
    assert mixed.count() >= near.count()
    out = _run(spark, "encode", mixed).where("doc_id is not null").dropDuplicates().collect()
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={})
    texts = {x["doc_id"]: x["text"] for x in near.collect()}
    assert all(x["n_tokens"] == len(encoding.encode_ordinary(texts[x["doc_id"]])) for x in out)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == mixed.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "mix", "encode"]


def test_empty_input(spark):
    docs = _docs(spark).where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0, name


def test_repeated_rows_of_one_id(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (1, "c", "en", "s", 1), (2, "ab", "en", "s", 2), (None, "ab", "en", "s", 2)], FIELDS)
    got = sorted((x["doc_id"], x["text"]) for x in corpus_pipeline.exact(spark, docs, "").collect())
    assert got == [(1, "a b"), (1, "c")]
    assert corpus_pipeline.exact(spark, docs.withColumn("n_chars", F.lit(0).cast("long")), "").count() == 2


def test_near_copies_among_rows_of_one_id(spark):
    r = random.Random(4)
    a, b, c, d, e = (" ".join(f"{r.choice('abcdefgh')}{r.randint(0, 999)}" for _ in range(60)) for _ in range(5))
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (3, c + " tail"), (4, d), (5, d + " x"), (5, d + " y"), (0, e), (7, e + " z"), (None, a + " none"), (8, None), (8, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], FIELDS)
    got = [(x["doc_id"], x["text"]) for x in corpus_pipeline.near(spark, docs, "").collect()]
    three = [x for x in got if x[0] == 3]
    assert len(three) == 1 and three[0] in rows
    assert sorted((x for x in got if x[0] != 3), key=str) == sorted([(1, a), (2, b), (4, d), (0, e), (None, a + " none"), (8, None), (8, "")], key=str)
