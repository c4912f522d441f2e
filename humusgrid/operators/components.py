"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from humusgrid.session import cut_lineage, drop_stage

#: Rounds after which something is wrong: they grow with the logarithm of the longest path.
MOST_ROUNDS = 60


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(id, component): every id of an edge with the smallest id it is connected to.

    Alternating large-star and small-star steps: each step links neighbours of a
    vertex to their smallest one, so long chains halve and a hot vertex only
    loses edges. Every round is written to the shared folder, which cuts the
    lineage, and the round before it deleted; the driver sees one count and one
    checksum per round.

    Defined results: edges with a null end are ignored; an edge from an id to
    itself makes a component of that id; repeated edges and loops change
    nothing; an empty table gives no rows.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a is not null and b is not null")
    alone = pairs.filter("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    links = cut_lineage(pairs.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    for _ in range(MOST_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u is linked to the smallest vertex around u
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        last, links = links, small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        links = cut_lineage(links, "links")
        drop_stage(last)
        now = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    members = links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")))
    return members.unionByName(alone).groupBy("id").agg(F.min("component").alias("component"))
