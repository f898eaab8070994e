"""Connected components of an edge table, by alternating star contractions on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.session import cut_lineage

# Edges run from the greater vertex ``u`` to the smaller ``v``. A contraction turns every edge into one edge at most, so the
# table never grows, and every row is read once for the minimum and once for the join: a round is a few short stages.


def _least(ends: DataFrame) -> DataFrame:
    """(_x, m): the least ``y`` of every ``x``, pre-aggregated per partition, so a hub is never gathered in one place."""
    return ends.groupBy(F.col("x").alias("_x")).agg(F.min("y").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands its greater neighbours to the least of itself and all its neighbours."""
    ends = edges.select(F.inline(F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in ("uv", "vu")])))
    return edges.join(_least(ends), F.col("v") == F.col("_x")).select("u", F.least("v", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands itself and its smaller neighbours to the least of these."""
    joined = edges.join(_least(edges.select(F.col("u").alias("x"), F.col("v").alias("y"))), F.col("u") == F.col("_x"))
    # the edge to the least one stays and stands for the vertex itself
    return joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _all_stars(edges: DataFrame) -> bool:
    """Does every ``u`` have one edge, to a ``v`` that is no other edge's ``u``? Then every component is a star around its least."""
    ends = edges.select(F.inline(F.array(*[
        F.struct(F.col(x).alias("x"), F.lit(down).alias("down"), F.lit(1 - down).alias("up")) for x, down in (("u", 1), ("v", 0))])))
    roles = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return roles.agg(F.count_if(F.col("down") + F.col("up") * F.least("down", F.lit(1)) > 1)).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every vertex of ``edges`` (u, v): root is the least id it is connected with. No edge, no rows."""
    current = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        current = cut_lineage(_small_star(_large_star(current).distinct()).distinct())
        if _all_stars(current):
            break
    return current.select(F.inline(F.array(*[F.struct(F.col(x).alias("id"), F.col("v").alias("root")) for x in "uv"]))).distinct()
