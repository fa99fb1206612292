"""Connected components as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of ``edges``; ``label`` is the smallest
    node reachable.  Any orderable node type; repeated edges, loops and null
    ends are allowed (the latter two link nothing).

    Alternating large-star and small-star steps: each round links every node's
    larger (then smaller) neighbours to its smallest one, so paths shorten and
    the edge set never grows beyond the first.  A node's smallest neighbour
    comes from a partial aggregate, so a node with very many neighbours is
    never gathered in one task; joining it back is a plain equi-join that
    adaptive execution splits.  Each round ends with a reliable ``checkpoint``.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    small, large = F.least(a, b), F.greatest(a, b)
    cur = (edges.where(F.col(a) != F.col(b)).select(large.alias("u"), small.alias("v"))
           .distinct().checkpoint())
    seen = None
    while True:
        cur = _star(_star(cur, larger=True), larger=False).checkpoint()
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        cur.select("v", "v").distinct())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """``edges`` hold u > v.  Larger: all neighbours count, and those above the
    node go to the least of node and neighbours.  Smaller: only neighbours
    below the node count, and they and the node itself go to the least."""
    if larger:
        links = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = (links.groupBy("u").agg(F.min("v").alias("m"))
                 .select("u", F.least("u", "m").alias("m")))
        out = (links.join(least, "u").where(F.col("v") > F.col("u"))
               .select(F.col("v").alias("u"), F.col("m").alias("v")))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        out = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.where(F.col("u") != F.col("v")).distinct()
