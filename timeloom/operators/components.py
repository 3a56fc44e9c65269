"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import durable

#: Links, counted first, up to which a round is one task; beyond that it is dealt by node.
TASK_LINKS = 200_000


def connected_components(links: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): each linked node with the smallest node it can reach.

    Alternating large-star and small-star rounds: every round hangs each node's neighbours on the smallest of
    them, so paths shorten by half and a hub costs one aggregated minimum. Rounds never add links; a table of few
    links stays in one partition, as dealing it anew several times a round costs more than the work. Loops and
    links with a null end are ignored; an empty table gives an empty result.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u > v").distinct()
    edges = durable(edges)
    few = edges.count() <= TASK_LINKS
    placed = lambda df: df.coalesce(1) if few else df
    edges, seen = placed(edges), None
    for _ in range(max_rounds):
        # large star: larger neighbours of u move to the smallest node around u
        both = placed(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = placed(placed(edges).distinct())
        # small star: u and its smaller neighbours move to the smallest of them
        least = placed(edges.groupBy("u").agg(F.min("v").alias("m")))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        moved = placed(moved.unionByName(least.select("u", F.col("m").alias("v"))))
        edges = placed(durable(moved.distinct()))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
