"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b): root is the smallest vertex of
    its component. Each round hooks every vertex to its smallest neighbour, follows the
    pointers to the ends by doubling, and contracts; the vertices at least halve, so the
    rounds are logarithmic. Every step is a join of written tables."""
    edges = written(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    done = None
    while done is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        point = written(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
                        .select("v", F.least("v", "m").alias("root")), "hooks")
        while True:
            step = written(_jump(_jump(point)), "jumps")
            point = step.select("v", "root")
            if step.where("moved").isEmpty():
                break
        if done is None:
            done = point
        else:
            up = point.select(F.col("v").alias("u"), F.col("root").alias("next"))
            done = written(done.join(up, done.root == up.u, "left").select(
                "v", F.coalesce("next", "root").alias("root")), "roots")
        a, b = (point.select(F.col("v").alias(x), F.col("root").alias(f"r{x}")) for x in ("a", "b"))
        edges = written(edges.join(a, "a").join(b, "b").where("ra != rb")
                        .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    return done


def _jump(point: DataFrame) -> DataFrame:
    """Every pointer moved on to where its target points."""
    up = point.select(F.col("v").alias("u"), F.col("root").alias("next"))
    return point.join(up, point.root == up.u, "left").select(
        "v", F.coalesce("next", "root").alias("root"), F.coalesce(F.col("next") < F.col("root"), F.lit(False)).alias("moved"))
