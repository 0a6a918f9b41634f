"""Connected components as DataFrame joins (alternating star contraction).

Each round hangs the larger neighbours of a node on its least neighbour, then
the smaller ones. Edges never grow in number, a component of any shape
becomes a star around its least node after a number of rounds that is about
logarithmic in its size, and no component is ever gathered in one task: a
hub's edges are only joined with its one minimum (adaptive skew join splits
them). Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.text import written


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none."""
    ends = (edges.select(F.col("u").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("above"))
            .unionAll(edges.select("v", F.lit(0), F.lit(1))))
    per = ends.groupBy("n").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return per.where((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))).isEmpty()


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge except the roots themselves;
    ``root`` is the least node of its component. Self-loops, repeated edges
    and either direction are fine."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    while not _is_star_forest(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least(both).select("u", F.least("u", "m").alias("m")), "u")
                 .where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.join(_least(large), "u")
        e = written(small.select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
