"""The registered queries of this subpackage, over the whole tables of a folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .langid import language_report
from .jaccard import near_groups
from . import mixing, preference, recipes
from .passages import repeated_passages
from .secrets import secret_report
from .tokenfiles import token_file_report
from .topk import top_k

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(_table(spark, folder, "documents"), width=4, num=85, den=100)


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(_table(spark, folder, "documents"))


def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_encode(_table(spark, folder, "documents"), MULTI, public_tokenizers.PATTERN, digests=True)


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.exact_groups(_table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_report(_table(spark, folder, "documents"), MULTI)


def op7_preference(spark: SparkSession, folder: str) -> DataFrame:
    return preference.adjacent_pairs(_table(spark, folder, "conversations"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(_table(spark, folder, "documents"))


def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(_table(spark, folder, "documents"), window=13)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_report(_table(spark, folder, "documents"), TOKENIZER, public_tokenizers.PATTERN, added_tokens=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


_WORDS = """d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
u AS (SELECT rid, doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d)"""

#: Kind, expression, its group that must reach a length, that length: the rules of the scanner as RE2 reads them.
_KINDS = [
    ("assign", "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA([A-Z0-9]+)", 1, 16),
    ("hex", "([0-9a-f]+)", 1, 24),
    ("bearer", "[Bb]earer\\x20+([A-Za-z0-9._~+/=-]+)", 1, 12),
    ("userinfo", "://[A-Za-z0-9._-]+:[A-Za-z0-9._%+-]+(@+)", 1, 1),
    ("pem", "-----BEGIN\\x20(?:[A-Z]+\\x20)*PRIVATE\\x20KEY(-+)", 1, 5),
]
_FOUND = " UNION ALL ".join(f"SELECT rid, {n} AS o, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{rx}') AS gaps, regexp_extract_all(t, '{rx}', 0) AS hits, regexp_extract_all(t, '{rx}', {group}) AS tails FROM d" for n, (kind, rx, group, least) in enumerate(_KINDS))

ORACLES: dict[str, str] = {
    "op8_secrets": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_FOUND}),
u AS (SELECT rid, o, kind, least, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit, unnest(tails) AS tail, unnest(range(len(hits))) AS i FROM f),
s AS (SELECT rid, o, kind, length(tail) >= least AS ok, length(hit) AS size, sum(length(gap) + length(hit)) OVER (PARTITION BY rid, o ORDER BY i) - length(hit) AS a FROM u),
x AS (SELECT rid, o, kind, a::BIGINT AS a, concat(kind, ':', a::BIGINT, ':', (a + size)::BIGINT) AS span FROM s WHERE ok)
SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
 sha256(coalesce(string_agg(span, ',' ORDER BY a, o) FILTER (o < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY a, o), '') AS spans
FROM d LEFT JOIN x USING (rid) GROUP BY rid, doc_id""",
    "op1_jaccard": f"""
WITH RECURSIVE {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
g AS (SELECT rid, string_agg(word, ' ') OVER f AS g, count(*) OVER f AS n FROM u WINDOW f AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
s AS (SELECT DISTINCT rid, g FROM g WHERE n = 4 UNION SELECT rid, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3),
z AS (SELECT d.rid, d.doc_id, count(s.g) AS n FROM d LEFT JOIN s USING (rid) GROUP BY ALL),
c AS (SELECT a.rid AS a, b.rid AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN z x ON x.rid = a JOIN z y ON y.rid = b WHERE x.doc_id IS NOT NULL AND y.doc_id IS NOT NULL AND 100 * same >= 85 * (x.n + y.n - same)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT rid, rid AS reached FROM z UNION SELECT r.rid, b FROM r JOIN both_ways ON a = reached)
SELECT z.doc_id, z.n AS n_shingles, min(t.doc_id) AS component_id FROM z JOIN r USING (rid) JOIN z t ON t.rid = reached GROUP BY z.rid, z.doc_id, z.n""",
    "op9_passages": f"""
WITH {_WORDS.format("coalesce(text, '')")},
g AS (SELECT rid, doc_id, i, word, string_agg(word, ' ') OVER f AS g, count(*) OVER f AS n FROM u WINDOW f AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
h AS (SELECT rid, i, word, coalesce(n = 13 AND doc_id > min(doc_id) OVER (PARTITION BY g, n), false) AS again FROM g),
k AS (SELECT rid, i, word, max(again) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM h)
SELECT doc_id, count(word) AS n_words, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid) GROUP BY rid, doc_id""",
    "op2_mixing": mixing.ORACLE,
    "op3_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
    "op5_exact_dedup": """
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY size DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k""",
    "op7_preference": preference.ORACLE,
}
