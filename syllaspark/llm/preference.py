"""Preference formatting of chosen and rejected conversations, in DataFrame operations only.

The turns that two conversations share from the start are rendered once, as the
prompt; what follows in each is a completion, with the spans of the assistant's own
words as its mask.

Rows: one output row per pair of which either conversation has a turn.  A missing
conversation has no turns: nothing is shared and its completion is empty.  A null
role is ``unknown``, a null text empty.  Turns are ordered by number, role and text,
a null number first; a repeated row is a turn of its own.  Rows with a null
conversation id belong to no pair and are left out.  A conversation is one value of
the result, so its turns meet in one row, however many they are.  Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the rendering.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def _mask(turns: Column) -> Column:
    """start:end (code points, end exclusive) of the assistant's texts and their closing marks, comma-joined."""
    close = len(CLOSE)

    def add(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(_head(t))
        end = begin + F.length(t["text"]) + close
        own = F.when(t["role"] == "assistant", F.array(F.concat_ws(":", begin.cast("string"), end.cast("string")))).otherwise(F.array().cast("array<string>"))
        return F.struct(end.alias("at"), F.concat(state["spans"], own).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, start, add, lambda s: s["spans"]), ",")


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """(pair_id, n_shared, prompt, chosen, rejected, chosen_mask, rejected_mask).

    ``turns`` has conv_id, turn, role and text; ``pair`` and ``chosen`` say, for each
    row, the pair that it belongs to and whether to its chosen side.  One shuffle
    gathers the turns of a pair, which a conversation's length bounds.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.select(pair.alias("pair_id"), chosen.alias("is_chosen"), turn.alias("t")).where(F.col("pair_id").isNotNull() & F.col("is_chosen").isNotNull())
    side = lambda yes: F.sort_array(F.collect_list(F.when(F.col("is_chosen") == yes, F.col("t"))))
    both = rows.groupBy("pair_id").agg(side(True).alias("a"), side(False).alias("b"))
    same = lambda i: (F.col("a")[i]["role"] == F.col("b")[i]["role"]) & (F.col("a")[i]["text"] == F.col("b")[i]["text"])
    least = F.least(F.size("a"), F.size("b"))
    differs = F.filter(F.when(least > 0, F.sequence(F.lit(0), least - 1)).otherwise(F.array().cast("array<int>")), lambda i: ~same(i))
    both = both.withColumn("n_shared", F.when(F.size(differs) > 0, F.array_min(differs)).otherwise(least).cast("long"))
    n = F.col("n_shared").cast("int")
    rest = lambda c: F.slice(c, n + 1, F.greatest(F.size(c) - n, F.lit(0)))
    both = both.select("pair_id", "n_shared", F.slice("a", F.lit(1), n).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    return both.select("pair_id", "n_shared", _rendered(F.col("p")).alias("prompt"), _rendered(F.col("a")).alias("chosen"), _rendered(F.col("b")).alias("rejected"), _mask(F.col("a")).alias("chosen_mask"), _mask(F.col("b")).alias("rejected_mask"))


def adjacent_pairs(conversations: DataFrame) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) as pair k."""
    conv = conversations["conv_id"]
    return preference_pairs(conversations, F.floor(conv / 2).cast("long"), F.pmod(conv, F.lit(2)) == 0)


#: Turn by turn, with windows instead of arrays.
ORACLE = """
WITH t AS (SELECT (conv_id // 2)::BIGINT AS pair_id, conv_id % 2 = 0 AS c, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, c ORDER BY turn NULLS FIRST, role, text) - 1 AS i, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS r FROM t),
x AS (SELECT pair_id, coalesce(min(a.i) FILTER (b.i IS NULL OR a.role <> b.role OR a.text <> b.text), max(a.i) + 1) AS k
  FROM (SELECT * FROM n WHERE c) a LEFT JOIN (SELECT * FROM n WHERE NOT c) b USING (pair_id, i) GROUP BY pair_id),
s AS (SELECT DISTINCT n.pair_id, coalesce(x.k, 0) AS k FROM n LEFT JOIN x USING (pair_id)),
o AS (SELECT n.*, s.k, sum(CASE WHEN i >= s.k THEN length(r) ELSE 0 END) OVER (PARTITION BY n.pair_id, c ORDER BY i) AS stop FROM n JOIN s USING (pair_id)),
m AS (SELECT *, concat(stop - length(text) - 8, ':', stop) AS span FROM o)
SELECT pair_id, any_value(k)::BIGINT AS n_shared,
  coalesce(string_agg(r, '' ORDER BY i) FILTER (c AND i < k), '') AS prompt,
  coalesce(string_agg(r, '' ORDER BY i) FILTER (c AND i >= k), '') AS chosen,
  coalesce(string_agg(r, '' ORDER BY i) FILTER (NOT c AND i >= k), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY i) FILTER (c AND i >= k AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(span, ',' ORDER BY i) FILTER (NOT c AND i >= k AND role = 'assistant'), '') AS rejected_mask
FROM m GROUP BY pair_id
"""
