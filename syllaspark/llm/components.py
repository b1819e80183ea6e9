"""Connected components of an edge table, without ever gathering a component."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship

#: Up to so many edges (16 bytes each) one task does; more are done by joins.
ONE_TASK = 1_000_000


def _in_one_task(batches):
    held = [np.column_stack([np.array(batch.column(k), np.int64) for k in (0, 1)]) for batch in batches]
    if not held:
        return
    nodes, place = np.unique(np.concatenate(held), return_inverse=True)
    a, b = place.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "label"])


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the least node reachable, for every node that an edge (a, b) names.

    Each level lets every node point to the least node within two steps, follows the
    pointers to their ends, and goes on with the edges between those ends, of which
    there are ever fewer.  Pointers lead downwards, so they have no cycles and end at
    the least node of a component at last.  Messages are aggregated before they are
    shuffled; a node with very many edges is split by the skew join, as both sides of
    each join are plain table scans.  Few edges are settled by one task instead.
    """
    ship(edges.sparkSession)
    edges = scratch.save(edges.select("a", "b").where("a <> b").distinct(), "edges")
    if edges.count() <= ONE_TASK:
        return scratch.save(edges.coalesce(1).mapInArrow(_in_one_task, "node long, label long"), "labels")
    pairs = edges
    now = scratch.save(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = None
    while labels is None or now.limit(1).collect():
        one = scratch.save(now.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("least")), "one")
        two = now.join(one.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("least").alias("far"))
        ends = scratch.save(one.join(two, "node").select("node", F.least("least", "far").alias("label")), "ends")
        while True:  # pointers of pointers
            on = ends.join(ends.select(F.col("node").alias("label"), F.col("label").alias("next")), "label")
            on = scratch.save(on.select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")), "ends")
            scratch.drop(ends)
            ends = on
            if not ends.where("moved").limit(1).collect():
                break
        ends = ends.select("node", "label")
        if labels is None:
            labels = ends
        else:
            labels = scratch.save(labels.join(ends.select(F.col("node").alias("label"), F.col("label").alias("least")), "label", "left").select("node", F.coalesce("least", "label").alias("label")), "labels")
        at = lambda n: ends.select(F.col("node").alias(n), F.col("label").alias(f"to_{n}"))  # noqa: B023, E731
        further = now.join(at("a"), "a").join(at("b"), "b").where("to_a <> to_b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct()
        further = scratch.save(further, "edges")
        scratch.drop(now)
        now = further
    return labels
