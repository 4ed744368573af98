"""Connected components of a link table, by alternating star contractions.

Every step is a grouped minimum and a join, so a node with very many links
is aggregated map-side and its join partition is split by AQE; nothing is
gathered in one task or on the driver but one row of totals per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import drop_written, written


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every higher neighbour of u points at the lowest of u and its neighbours."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("m", "u").alias("m"))
    # (u, v) with v < u gives (u, min of v's star)
    return (links.join(low.withColumnRenamed("u", "v"), "v")
            .select("u", F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """u and its lower neighbours point at the lowest of them."""
    low = _lowest(links)
    moved = links.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link.

    ``links`` has two columns of one orderable type; null ends, self-links
    and repeats are ignored. ``component`` is the lowest node reachable.
    An empty link table gives an empty result.
    """
    cur = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                  .distinct(), "links")
    before = None
    while True:
        # a star forest (no v is itself a u) cannot change any more
        totals = cur.agg(F.count("*").alias("n"),
                         F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if totals["n"] == 0 or (totals["n"], totals["h"]) == before:
            break
        before = (totals["n"], totals["h"])
        nxt = written(_small_star(_large_star(cur)), "links")
        drop_written(cur)
        cur = nxt
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
