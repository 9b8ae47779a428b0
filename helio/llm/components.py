"""Connected components of a link table: local forests and alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.common import cut

#: Links that one task of a round takes; the number of tasks follows from it and the links there are.
ROWS_A_TASK = 500_000


def group_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index that each of n nodes reaches over the links i-j."""
    group = np.arange(n)
    while True:
        low = group.copy()
        np.minimum.at(low, i, group[j])
        np.minimum.at(low, j, group[i])
        low = low[low]
        if (low == group).all():
            return group
        group = low


def _forest(edges: DataFrame) -> DataFrame:
    """The links of each partition as stars: each node to the least one that it reaches there."""

    def run(batches):
        parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
        if parts:
            a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
            nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            group = group_of(len(nodes), at[: len(a)], at[len(a) :])
            moved = np.flatnonzero(group != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[group[moved]])], ["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (large) or smaller neighbours, itself included, to the least node among them.

    The least neighbours are cut, so that both sides of the join come from plain exchanges and Spark can split a hub's links.
    """
    pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = cut(pairs.groupBy("a").agg(F.min("b").alias("_b")).select("a", F.least("a", "_b").alias("_m")))
    joined = pairs.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(least.select("a", F.col("_m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """(id, component) of all nodes of ``edges`` (a, b: long); a component is named by its least node.

    Nodes without links are left out, as are links of a node to itself and null ends; no links give no rows. In
    each round every task of at most about ``rows_a_task`` links makes a forest of its links; where there are
    several tasks, a large and a small star join the forests, until nothing changes. Rounds are checkpointed.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        tasks = 1 + now[0] // rows_a_task
        local = _forest(e.coalesce(tasks))
        if tasks == 1:
            e = cut(local)
            break
        e = cut(_star(_star(cut(local), True), False))
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
