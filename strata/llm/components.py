"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star steps: every vertex points its larger
neighbours, then all its neighbours, at the smallest one.  Each step is a
grouped minimum (combined map-side) and a join that Spark can split where a
vertex has very many links.  The links of a step are written to the shared
folder, so lineage stays short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

MAX_STEPS = 60


def _star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    low = both.groupBy("u").agg(F.min("v").alias("v0")).select("u", F.least("u", "v0").alias("m"))
    large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    small = large.groupBy("a").agg(F.min("b").alias("m"))
    linked = large.join(small, "a")
    return (linked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.toDF("a", "b")).distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (two long columns): the
    smallest id reachable.  Self links, repeated and null links are allowed."""
    a, b = links.columns
    edges = (links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct())
    edges = materialize(edges, "links")
    mark, before = _mark(edges), None
    for _ in range(MAX_STEPS):
        if mark == before or mark[0] == 0:
            break
        edges = materialize(_star(edges), "links")
        mark, before = _mark(edges), mark
    else:
        raise RuntimeError("components did not settle")
    return edges.toDF("id", "component").union(edges.select(F.col("b"), F.col("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
