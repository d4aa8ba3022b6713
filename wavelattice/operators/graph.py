"""Connected components as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wavelattice.operators.skew import join_facts
from wavelattice.session import cut_lineage, fresh_cut


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node id reachable from each node over edges ``u, v``.

    Every round a node takes the smallest label among its neighbours and then its label's label
    (pointer jumping), so long chains shrink geometrically. Each round is checkpointed.
    """
    real = edges.filter(F.col("u") != F.col("v"))
    both = cut_lineage(real.select("u", "v").union(real.select(F.col("v"), F.col("u"))).distinct())
    labels = cut_lineage(nodes.select("node", F.col("node").alias("comp")))
    while True:
        offered = (both.join(labels, F.col("u") == F.col("node")).groupBy(F.col("v").alias("_n"))
                   .agg(F.min("comp").alias("offer")))
        hooked = labels.join(offered, F.col("node") == F.col("_n"), "left").select(
            "node", F.col("comp").alias("old"), F.least("comp", F.coalesce("offer", "comp")).alias("comp"))
        parent = hooked.select(F.col("node").alias("_p"), F.col("comp").alias("jump"))
        moved = cut_lineage(hooked.join(parent, F.col("comp") == F.col("_p")).select(
            "node", F.col("jump").alias("comp"), (F.col("jump") != F.col("old")).alias("changed")))
        labels = moved.select("node", "comp")
        if moved.filter("changed").isEmpty():
            return labels


def star_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, comp`` as :func:`connected_components`, by alternating large and small stars.

    A large star hangs all larger neighbours of a node on the smallest node around it, a small star all smaller ones, until
    every component is one star. The edges never grow in number, and a hub's edges are spread over salts, so neither a node
    of very many neighbours nor a component that holds all nodes meets in one task.
    """
    real = edges.filter(F.col("u") != F.col("v"))
    held = fresh_cut(real.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct())
    while not _is_star_forest(held):
        both = held.select(F.col("a").alias("u"), F.col("b").alias("v")).union(held.select("b", "a"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        large = fresh_cut(join_facts(both.filter(F.col("v") > F.col("u")), least, "u", "n", "v").select(
            F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = join_facts(large, least, "a", "n", "b").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        held = fresh_cut(small.select("e.a", "e.b").filter(F.col("a") != F.col("b")).distinct())
    root = held.select(F.col("a").alias("_n"), F.col("b").alias("_root"))  # one edge per node that is not a root
    return fresh_cut(nodes.select("node").join(root, F.col("node") == F.col("_n"), "left").select(
        "node", F.coalesce("_root", "node").alias("comp")))


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every ``a`` has one edge, and no ``b`` hangs on another node."""
    ends = edges.groupBy("a").agg(F.count("*").alias("n"))
    if not ends.filter("n > 1").isEmpty():
        return False
    return edges.select(F.col("b").alias("_b")).distinct().join(edges, F.col("_b") == F.col("a"), "left_semi").isEmpty()
