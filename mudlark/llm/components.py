"""Connected components of a distributed list of links (union-find by alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mudlark.llm.common import materialise


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` of every node of ``links(src, dst)``; a component is named by its smallest node.

    Each round points the larger neighbours of every node, then the smaller ones, at the smallest neighbour;
    neighbourhoods are only ever aggregated to their minimum, never gathered. Ends when a round changes nothing; an
    error is raised if that takes more than ``most_rounds``.
    Null ends and links of a node to itself are left out; an empty list gives no rows.
    """
    edges = links.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    edges = materialise(edges, "links")
    state = None
    for _ in range(most_rounds):
        # large star: u's neighbours above u, and u itself, point at u's least neighbour
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u's neighbours below u, and u itself, point at the least of them
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = materialise(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).head()
        if state == (now["n"], now["s"]):
            break
        state = (now["n"], now["s"])
    else:
        raise RuntimeError(f"components: links still change after {most_rounds} rounds")
    # every node but the least now points at the least
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
