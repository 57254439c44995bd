"""Connected components of a graph whose edges stay distributed (large-star, small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger neighbours (large) or smaller ones and itself (small) to its least one."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes with an edge; component is the least node reachable.

    Rounds go on until the edges are stars, in about the logarithm of the longest path; each round
    is written to the shared folder, so lineage stays short and a lost executor costs one round.
    NULL ends and loops are ignored; repeated and reversed edges count once. No edges, no rows.
    """
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct(), "components")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("s")).first()
        if not state.n or state == seen:
            break
        seen = state
        grown = _stars(now, large=True)
        now = stored(_stars(grown, large=False), "components", state.n)  # a round has no more edges than the last
    roots = now.select(F.col("b").alias("a")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select(F.col("a").alias("node"), F.col("a").alias("component")))
