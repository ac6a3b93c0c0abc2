"""Connected components of an edge table, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written


SALTS = 32  # pieces of the neighbours of a node


def _least_neighbour(edges: DataFrame, own: bool) -> DataFrame:
    """`u, v, m` of edges `u, v`, with the smallest neighbour of u (or u itself, where `own`). The edges of
    a node are dealt to `SALTS` pieces; only one number of each piece meets those of the others."""
    salted = edges.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).repartition("u", "_salt")
    pieces = salted.groupBy("u", "_salt").agg(F.min("v").alias("_m"))
    whole = pieces.groupBy("u").agg(F.min("_m").alias("m"), F.collect_list("_salt").alias("_salts"))
    if own:
        whole = whole.withColumn("m", F.least("m", "u"))
    of_piece = whole.select("u", F.explode("_salts").alias("_salt"), "m")  # at most `SALTS` rows of a node
    return salted.join(of_piece, ["u", "_salt"]).select("u", "v", "m")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node of edges `u, v` (each once) has either one edge up, and none to it, or no edge up."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = up.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up = 1 AND down = 1)").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node of edges `a, b`; `root` is the smallest node of its component.

    Large-star and small-star rounds in turn (Kiveris et al., 2014): each links the neighbours of a
    node to the smallest of them, until each component is a star around its smallest node. The edges of a
    busy node are spread over tasks. Every round is written to the shared folder, so a lost executor costs
    one round. Null ends and loops are left out; no edges give no rows.
    """
    state = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while not _all_stars(state):
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both, own=True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v"), "edges")
        least = _least_neighbour(large, own=False)
        small = least.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        state = written(small, "edges")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
