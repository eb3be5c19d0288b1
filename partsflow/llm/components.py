"""Connected components of a link table, by alternating large-star and
small-star steps (distributed union-find).  DataFrame operations only: each
step is a minimum per node (combined map-side) and an equi-join, which AQE can
split on a hot node; the links of a node are never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from partsflow.llm.common import discard, materialize


def _min_neighbour(both: DataFrame) -> DataFrame:
    return both.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = _min_neighbour(both).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    m = _min_neighbour(down)
    moved = down.join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(m.select("a", F.col("m").alias("b"))).where("a <> b")


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a, b of one orderable type) -> (node, root), root the smallest
    node of the component.  Nodes without a link to another node are absent;
    null ends and self links are ignored; an empty table gives an empty one."""
    e = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        last, e = e, materialize(_small_star(_large_star(e)).distinct(), "links")
        discard(last)
        mark = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())
        if mark == seen or mark[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
