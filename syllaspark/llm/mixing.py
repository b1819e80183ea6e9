"""Mixing sources to target weights by temperature, in DataFrame operations only.

A source's share of the tokens is raised to an exponent and normalised: 1 keeps the
shares, 0 makes them even.  The exponent is bisected on a grid: the largest that
reaches a target entropy, raised as far as a repetition limit asks.  Weights become
token budgets, and budgets whole passes over a source plus a part of one more pass:
documents are permuted by a digest, in blocks of equal leading digits, and the last
pass ends with the document that fills the budget.

A pass is cut by one digest for each source, which block sums locate: no task ever
orders a whole source, and no text moves.

Rows: one output row per input row, also where nothing of a document is taken.  A
null source is a source of its own.  A null or empty text has no tokens; rows of
equal id are taken or left together, and so are the rows of a source without an id.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch

#: Steps of the exponent between 0 and 1.
GRID = 4096
#: Sources up to this number are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def token_count(text: Column) -> Column:
    """Words of the text: a stand-in for tokens that SQL engines count alike."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _measures(sources: DataFrame, exponents: list[int], total: int, budget: float | None) -> dict[int, tuple[float, float]]:
    """For each exponent (in steps) the entropy of the weights and the most passes over any source."""
    share = F.col("tokens") / F.lit(float(total))
    rows = sources.where("tokens > 0").withColumn("step", F.explode(F.array(*[F.lit(e) for e in exponents])))
    power = F.pow(share, F.col("step") / F.lit(float(GRID)))
    rows = rows.select("step", share.alias("share"), power.alias("power"))
    got = rows.groupBy("step").agg(F.sum("power").alias("z"), F.sum(F.col("power") * F.ln("power")).alias("zl"), F.max(F.col("power") / F.col("share")).alias("rare"), F.min(F.col("power") / F.col("share")).alias("common")).collect()
    # with weights power / z, entropy is ln z - sum(power ln power) / z; passes are budget * weight / tokens
    return {r["step"]: (math.log(r["z"]) - r["zl"] / r["z"], (budget / total) * r["rare"] / r["z"] if budget is not None else r["rare"] / r["common"]) for r in got}


def _bisect(low: int, high: int, good, measure) -> int:
    """The largest step in [low, high] that is good, where all below it are; each round tries 16 at once."""
    while low < high:
        width = -(-(high - low) // 16)
        tries = sorted({min(high, low + width * k) for k in range(1, 17)})
        seen = measure(tries)
        held = [t for t in tries if good(seen[t])]
        low, high = (max(held), min([t - 1 for t in tries if t > max(held)], default=max(held))) if held else (low, tries[0] - 1)
    return low


class Plan:
    """How often each document is taken: whole passes by source, and the digest that ends the last one."""

    def __init__(self, docs: DataFrame, entropy_share: float, most_passes: float, budget_share: float | None, id_col: str, text_col: str, source_col: str, seed: str):
        self.id_col, self.source_col, self.seed = id_col, source_col, seed
        scratch = Scratch(docs.sparkSession, "mixture")
        self.rows = rows = scratch.save(docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), self.of(docs).alias("of"), token_count(docs[text_col]).alias("tokens")), "rows")
        sources = scratch.save(rows.groupBy("of").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "sources")
        head = sources.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("sources"), F.sum((F.col("tokens") > 0).cast("long")).alias("live"), F.sum("n").alias("n")).first()
        self.small = head["sources"] <= BROADCAST_SOURCES
        total, live = head["tokens"] or 0, head["live"] or 0
        idle = int(budget_share is None)  # passes over a source without tokens
        if not total:
            self.cuts = sources.select("of", *[F.lit(n).cast("long").alias(c) for c, n in (("source_budget", 0), ("passes", idle), ("rest", 0))], F.lit(None).cast("string").alias("cut"))
            return
        budget = None if budget_share is None else budget_share * total
        measure = lambda tries: _measures(sources, tries, total, budget)
        target = entropy_share * math.log(live) if live > 1 else 0.0
        step = _bisect(0, GRID, lambda m: m[0] >= target, measure)
        if measure([step])[step][1] > most_passes:  # the least exponent within the limit, or 1
            step = GRID - _bisect(0, GRID - step, lambda m: m[1] <= most_passes, lambda tries: {t: measure([GRID - t for t in tries])[GRID - t] for t in tries})
        power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(step / GRID))).otherwise(0.0)
        z, least = sources.agg(F.sum(power), F.min(F.when(F.col("tokens") > 0, power / F.col("tokens")))).first()
        whole = float(budget) if budget is not None else z / least
        share = F.floor(power / F.lit(z) * F.lit(whole)).cast("long")
        plan = sources.select("of", "tokens", (share if budget is not None else F.greatest("tokens", share)).alias("budget"))
        plan = plan.select("of", F.col("budget").alias("source_budget"), F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(idle).alias("passes"), F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest"))
        plan = scratch.save(plan, "plan")

        digits = 2 + (head["n"] > 10**7) + (head["n"] > 10**9)
        dealt = rows.join(self.near(plan), "of").withColumn("digest", self.digest(F.col("id"))).withColumn("block", F.substring("digest", 1, digits))
        blocks = dealt.groupBy("of", "block").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
        before = F.sum("tokens").over(Window.partitionBy("of").orderBy("block")) - F.col("tokens")
        edge = blocks.withColumn("before", before).where("before < rest and rest <= before + tokens").select("of", F.col("block").alias("edge"), (F.col("rest") - F.col("before")).alias("need"))
        edge = scratch.save(edge, "edge")
        inside = dealt.join(self.near(edge), "of").where("block = edge").groupBy("of", "need", "digest").agg(F.sum("tokens").alias("tokens"))
        filled = F.sum("tokens").over(Window.partitionBy("of").orderBy("digest"))
        cuts = inside.withColumn("filled", filled).where("filled >= need").groupBy("of").agg(F.min("digest").alias("cut"))
        self.cuts = scratch.save(plan.join(cuts, "of", "left"), "cuts")
        scratch.keep(rows, self.cuts)

    def of(self, docs: DataFrame) -> Column:
        return F.coalesce(F.concat(F.lit("="), docs[self.source_col].cast("string")), F.lit("none"))

    def near(self, frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if self.small else frame

    def digest(self, id_: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(self.seed), F.col("passes").cast("string"), F.coalesce(id_.cast("string"), F.lit("null"))))

    def copies(self, id_: Column) -> Column:
        return (F.col("passes") + F.coalesce((self.digest(id_) <= F.col("cut")).cast("long"), F.lit(0))).cast("long")


def mixture(docs: DataFrame, entropy_share: float = 0.95, most_passes: float = 4.0, budget_share: float | None = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """(id, source, n_tokens, source_budget, copies) for every row.

    ``entropy_share`` is the target entropy as a share of the greatest possible;
    ``most_passes`` limits how often any source is repeated and outweighs the target.
    The budget is ``budget_share`` times all tokens; None asks for the least budget
    that takes every source whole, so that mixing repeats documents and drops none;
    a source without tokens is then taken once.
    """
    plan = Plan(docs, entropy_share, most_passes, budget_share, id_col, text_col, source_col, seed)
    out = plan.rows.join(plan.near(plan.cuts), "of")
    return out.select(F.col("id").alias(id_col), "source", F.col("tokens").alias("n_tokens"), "source_budget", plan.copies(F.col("id")).alias("copies"))


def mixed(docs: DataFrame, entropy_share: float = 0.95, most_passes: float = 4.0, budget_share: float | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The realised mixture: each row of ``docs``, all its columns, as often as it is taken.

    A row without tokens is taken as often as its source's whole passes say.
    """
    plan = Plan(docs, entropy_share, most_passes, budget_share, id_col, text_col, source_col, seed)
    rows = docs.select(plan.of(docs).alias("of"), F.struct(*[docs[c] for c in docs.columns]).alias("row")).join(plan.near(plan.cuts), "of")
    return rows.withColumn("copies", plan.copies(F.col("row")[id_col])).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")


#: The same with one window over each source instead of blocks.
ORACLE = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS t FROM d GROUP BY source),
tot AS (SELECT sum(t)::DOUBLE AS total, count(*) FILTER (t > 0) AS live FROM s),
g AS (SELECT e, pow(t / total, e / {GRID}.0) AS p, t / total AS share, live FROM s, tot, range(0, {GRID + 1}) AS r(e) WHERE t > 0),
m AS (SELECT e, ln(sum(p)) - sum(p * ln(p)) / sum(p) AS h, max(p / share) / sum(p) AS passes, any_value(live) AS live FROM g GROUP BY e),
a AS (SELECT max(e) FILTER (h >= 0.95 * ln(live)) AS e1 FROM m),
b AS (SELECT coalesce(min(e) FILTER (e >= coalesce(e1, 0) AND passes <= 4.0), {GRID}) AS e FROM m, a),
w AS (SELECT source, t, CASE WHEN t > 0 THEN pow(t / total, e / {GRID}.0) ELSE 0.0 END AS p, total FROM s, tot, b),
q AS (SELECT source, t, floor(p / (SELECT sum(p) FROM w) * total)::BIGINT AS budget FROM w),
o AS (SELECT d.doc_id, d.source, n_tokens, budget, CASE WHEN t > 0 THEN budget // t ELSE 0 END AS passes, CASE WHEN t > 0 THEN budget % t ELSE 0 END AS rest
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY md5(concat('mix:', passes, ':', doc_id))) - n_tokens AS before FROM o)
SELECT doc_id, source, n_tokens, budget AS source_budget, (passes + CASE WHEN before < rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM c
"""
