"""Connected components of links, and rows picked by a list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.sources.scratch import Scratch

# Ids are broadcast up to this many (some 50 MB as a hash table); beyond it they are joined.
BROADCAST_IDS = 1 << 20


def picked(rows: DataFrame, key: str, ids: DataFrame, without: bool = False) -> DataFrame:
    """The rows whose key is in the single column of ids; `without`: those where it is not.

    ids: a stored table, since it is counted first.
    """
    ids = ids.toDF(key)
    small = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if small else ids, key, "left_anti" if without else "left_semi")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node and component, the smallest node reachable, of every node with a link.

    links: two columns of nodes. Large-star and small-star steps alternate until nothing
    changes; each is an aggregation by node and a join back, so a hub's links stay spread.
    """
    a, b = links.columns
    links = links.filter(F.col(a) != F.col(b))
    now = scratch.keep(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    mark = None
    while True:
        found = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if mark == tuple(found) or not found["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = tuple(found)
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = small.union(least.select("a", F.col("m").alias("b")))
        now = scratch.keep(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
