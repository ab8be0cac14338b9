"""Connected components of an undirected graph, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b); a component is named by one of its nodes.

    In each round every node joins the first of its neighbours and itself in an order drawn anew, and edges within a
    component go. The number of nodes falls by a share in each round, whatever the shape of the graph.
    """
    labels = written(edges.selectExpr("a as node").union(edges.selectExpr("b as node")).distinct().withColumn("component", F.col("node")), "components")
    open_ = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    turn = 0
    while not open_.isEmpty():
        turn += 1
        both = open_.union(open_.select("b", "a"))
        first = F.min(F.struct(F.xxhash64(F.col("b"), F.lit(turn)).alias("draw"), F.col("b").alias("to")))
        own = F.struct(F.xxhash64(F.col("a"), F.lit(turn)).alias("draw"), F.col("a").alias("to"))
        hooks = both.groupBy("a").agg(first.alias("best")).select(F.col("a").alias("at"), F.least("best", own)["to"].alias("to"))
        hooks = written(hooks, "hooks")
        labels = labels.join(hooks, labels.component == hooks["at"], "left").select("node", F.coalesce("to", "component").alias("component"))
        left, right = hooks.select(F.col("at").alias("a"), F.col("to").alias("to_a")), hooks.select(F.col("at").alias("b"), F.col("to").alias("to_b"))
        moved = open_.join(left, "a").join(right, "b").where("to_a <> to_b")
        open_ = written(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        labels = written(labels, "components")
    return labels
