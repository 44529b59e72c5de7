"""Connected components by pointing to the first neighbour, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of `edges` (LONG ends); label: one node of the component, the same for all its nodes.

    Each round orders the nodes anew by a hash, points a node to the first within two steps (partial aggregates, so a hub is
    no hot task), jumps twice along the pointers and contracts: edges between nodes that now have one
    label are gone, the others are merged. In a hashed order pointers form short chains, so a path of n nodes takes about
    log n rounds, and a dense family of copies is one node after the first. Rows are cut as written tables in each round
    and nothing but the "edges left" bit reaches the driver. The joins ask for a merge: labels are neither small for sure
    nor worth a broadcast per round. No edges: no rows, and an edge from a node to itself is none.
    """
    left = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u <> v").distinct()
    left = written(left)
    labels, turn = None, 0
    while True:
        turn += 1

        def place(node: str, at: int = turn):
            return F.struct(F.xxhash64(node, F.lit(at)).alias("h"), F.col(node).alias("n"))

        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy(F.col("u").alias("near_of")).agg(F.min(place("v")).alias("near"))
        near = near.select("near_of", F.least(place("near_of"), "near").alias("near"))
        # the first within two steps: a node is a neighbour of its neighbours
        step = both.join(near.hint("merge"), F.col("v") == F.col("near_of"))
        step = step.groupBy(F.col("u").alias("node")).agg(F.min("near").alias("label"))
        for _ in range(2):
            to = step.select(F.col("node").alias("at"), F.col("label").alias("next"))
            step = step.join(to.hint("merge"), F.col("label")["n"] == F.col("at")).select("node", F.least("label", "next").alias("label"))
        step = written(step.select("node", F.col("label")["n"].alias("label")))
        to = step.select(F.col("node").alias("was"), F.col("label").alias("next"))
        if labels is None:
            labels = step
        else:
            labels = labels.join(to.hint("merge"), F.col("label") == F.col("was"), "left")
            labels = written(labels.select("node", F.coalesce("next", "label").alias("label")))
        moved = left.join(to.hint("merge"), F.col("u") == F.col("was")).select(F.col("next").alias("x"), "v")
        moved = moved.join(to.hint("merge"), F.col("v") == F.col("was")).select("x", F.col("next").alias("y"))
        left = written(moved.filter("x <> y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct())
        if left.isEmpty():
            return labels
