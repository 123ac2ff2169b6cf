"""Connected components of an edge table, on Spark tables only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import join_counted, map_arrow, stage
from docketry.plans.sizes import is_small


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is its smallest node.

    First each task joins what its own edges connect and passes on one edge for each
    node it saw.  Then edges are rewritten to point to ever smaller neighbours, from
    each node to its larger ones and among its smaller ones, until every node points
    to the smallest of its component.  A round is a few grouped minima, made before the
    shuffle, and joins with them: by broadcast where there are few edges, which no round
    makes more, else by ``join_counted``; so a hub's edges are never gathered.  Each
    round's edges are written, so nothing grows with the number of rounds.  No edges
    give no rows; loops and repeated edges do no harm.
    """
    now = stage(map_arrow(edges.select("a", "b").where("a != b"), _contract, "u bigint, v bigint"), "components-first")
    few = is_small(now)
    while True:
        now = stage(_small_star(_large_star(now, few), few), "components")
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            now.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        # Done when all edges lead from nodes with one edge to nodes with none of their own.
        open_ = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if open_.where("out > 1 OR (out > 0 AND into > 0)").isEmpty():
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )


def _contract(batches):
    """One edge from each node of this task's edges to the smallest they connect it with."""
    parent: dict[int, int] = {}

    def root(a: int) -> int:
        while (up := parent.setdefault(a, a)) != a:
            parent[a] = a = parent.setdefault(up, up)
        return a

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    pairs = np.array([(a, r) for a in list(parent) if (r := root(a)) != a], np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def _with_least(edges: DataFrame, least: DataFrame, few: bool) -> DataFrame:
    if few:
        return edges.join(F.broadcast(least), "u")
    return join_counted(edges, stage(least, "components-least"), "u", "edges")


def _least(edges: DataFrame) -> DataFrame:
    """Of each ``u`` its smallest neighbour ``m`` and the number of its edges."""
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("edges"))


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"), "edges")
    return _with_least(both.where("v > u"), least, few).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    edges = edges if few else stage(edges.distinct(), "components-large")
    least = _least(edges)
    moved = _with_least(edges, least, few).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
