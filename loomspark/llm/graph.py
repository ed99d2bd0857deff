"""Connected components by alternating stars, without a hub of any size in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import materialize


#: Edges that a task of a step has, about, and tasks at least.
EDGES, TASKS = 10_000, 4


def _stars(edges: DataFrame, tasks: int) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b; the result has that form too.

    Minima are written before they are joined: a join of two plain tables broadcasts them while they are few, and has its skewed keys
    (the node in the middle of a star) split by adaptive execution when they are many. A join on an aggregate's own shuffle could not.
    Tables have partitions by their rows: the edges are few beside the documents that they come from.
    """
    write = lambda x: materialize(x.coalesce(tasks))
    lower = write(edges.groupBy("a").agg(F.min("b").alias("m")))  # nodes without a row are local minima and stay
    large = write(edges.join(lower.withColumnRenamed("a", "b"), "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct())
    small = write(large.groupBy("a").agg(F.min("b").alias("m")))
    moved = large.join(small, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return write(moved.unionByName(small.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (a, b) of longs, in any order and repeated at will -> node, component (its smallest node), for nodes with an edge.

    Loops count for nothing; an empty table gives an empty one. Each round is written to the shared folder.
    """
    now = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(rounds):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        now = _stars(now, max(TASKS, -(-state["n"] // EDGES)))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
