"""Connected components of a link table by star contraction.

Each round turns every node's larger neighbours towards the node's smallest
neighbour (large star) and then the smaller ones (small star), as published by
Kiveris et al. (2014). Minima are pre-aggregated before the shuffle and joined
back, so a node with very many links is never gathered in one task: the plain
equi-joins can be split when skewed. Every round's links are written to the
shared folder; nothing about nodes or links reaches the driver but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import discard, stage_table


def _min_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _written(links: DataFrame, *read: DataFrame) -> DataFrame:
    """The links written out; what they were made from is deleted."""
    done = stage_table(links, "links")
    discard(*read)
    return done


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stage_table(_min_neighbour(both), "large-star-min")
    turned = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    return _written(turned, low, links)


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the larger to the smaller node."""
    low = stage_table(_min_neighbour(links), "small-star-min")
    turned = links.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _written(turned.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(), low, links)


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that has a link; ``component`` is the
    smallest node reachable (a written table). Null ends, self links and repeated links change
    nothing; no links give no rows. Ends must be of one ordered type."""
    u, v = F.col(a), F.col(b)
    links = stage_table(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), (u.isNotNull() & v.isNotNull()).alias("ok"))
                        .where("ok and u != v").select("u", "v").distinct(), "links")
    def state(df: DataFrame):
        return df.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state(links)
    while before[0]:
        links = _small_star(_large_star(links))
        after = state(links)
        if after == before:
            break
        before = after
    labels = stage_table(links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "labels")
    discard(links)
    return labels
