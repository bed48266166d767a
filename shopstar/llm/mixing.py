"""Mixing sources to target weights by apportioning equal-token blocks (Sainte-Laguë).

A text's size is its number of words. Sources, by code point with null last, weigh as the
given weights, repeated; together they are to give `share` of all words. No source gives
more than `most` times its size: what would exceed that is dealt to the others by weight,
which is the level at which the capped shares add up.

Targets become whole blocks. Block seats go to sources by highest quotient, target over
2 * seats + 1, and a source's seats to its shards in the same way by their words. A shard
is a hash class of the source's documents; it lays them end to end in seeded order and cuts
them into blocks. With q seats for n blocks every block is taken q div n times, and q mod n
consecutive ones, from a seeded place on and around the end, once more. So a document is
taken at most `most` times, and all but a few are taken whole.

Blocks are as large as leaves each source with words 256 of them, at most `block_words`.
Shards hold some `shard_words` words, more if there would be over `shards` of them, so that
the windows over a source's shards and over a shard's documents stay bounded. Sources are
set by hand and ranked in one task: a row for each, never one for each document.

Null texts and texts without words have size 0, of which 0 is taken; a null source is a
source of its own. Repeated rows count each. Rows alike in id and text are interchangeable.
No row gives no row. Everything is DataFrame operations, without Python code on data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.llm.links import BROADCAST_IDS
from shopstar.sources.scratch import Scratch, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 256
SHARD_WORDS = 1 << 17
SHARDS = 100_000
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str) -> Column:
    """Number of words; 0 for a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _place(seed: int) -> Column:
    """What rows are ordered by; alike for rows of the same id and text."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds weight and target (words, double) to rows of source and source_size."""
    turn = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    # With the sources that reach their cap first in front, the level is the largest that
    # any cut gives: those before it at their caps, the rest by weight.
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    capped = F.coalesce(F.sum("source_size").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    levels = weighed.withColumn("_level", (total * F.lit(float(share)) - capped * most) / left)
    level = F.max("_level").over(Window.partitionBy())
    target = F.least(F.col("source_size") * F.lit(float(most)), F.greatest(level, F.lit(0.0)) * F.col("weight"))
    return levels.withColumn("target", target).drop("_level")


def apportion(parties: DataFrame, group: list[str], order: list, weight: str, seats: str, cap: str) -> DataFrame:
    """Adds quota: each group's seats dealt to its parties by highest quotients.

    A party gets at most its cap. The divisor that fits lies within half a seat a party of
    the mean, so seats above that are sure, and only those around it have to be ranked.
    """
    own = Window.partitionBy(*group)
    count = F.sum(F.when(F.col(weight) > 0, 1).otherwise(0)).over(own)
    whole = F.sum(weight).over(own)
    per = lambda n: F.when(F.col("_whole") > 0, F.col(weight) * n / F.col("_whole")).otherwise(0.0)
    counted = parties.withColumns({"_count": count, "_whole": whole})
    low = F.floor(per(F.greatest(F.col(seats) - F.col("_count") / 2, F.lit(0.0))) + 0.5)
    high = F.floor(per(F.col(seats) + F.col("_count") / 2) + 0.5) + 2
    ranged = counted.withColumns(
        {"_low": F.least(F.greatest(low - 1, F.lit(0)), cap), "_high": F.least(F.when(F.col(weight) > 0, high).otherwise(0), cap)}
    )
    ranged = ranged.withColumn("_left", F.col(seats) - F.sum("_low").over(own))
    offers = ranged.withColumn("_seat", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence("_low", F.col("_high") - 1))))
    quotient = F.col(weight) / (2 * F.col("_seat") + 1)
    best = own.orderBy(F.desc_nulls_last(quotient), *order)
    won = F.col("_seat").isNotNull() & (F.row_number().over(best) <= F.col("_left"))
    dealt = offers.withColumn("_won", won.cast("bigint"))
    summed = dealt.groupBy(*parties.columns, "_low").agg(F.sum("_won").alias("_more"))
    return summed.withColumn("quota", F.col("_low") + F.col("_more")).select(*parties.columns, "quota")


def _overlap(begin: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.least(end, high) - F.greatest(begin, low), F.lit(0))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target (of the source) and taken, for every row."""
    with Scratch(docs.sparkSession) as scratch:
        return stored(_mixed(docs, scratch, weights, share, most, block_words, shard_words, shards, seed))


def _mixed(docs, scratch, weights, share, most, block_words, shard_words, shards, seed) -> DataFrame:
    sized = scratch.keep(
        docs.select("doc_id", "source", size_of("text").alias("size"), _place(seed).alias("place"))
    )
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    all_words = F.sum("source_size").over(Window.partitionBy())
    least = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(Window.partitionBy())
    block = F.greatest(F.least(F.floor(least / 256), F.lit(block_words)), F.lit(1)).cast("bigint")
    per_shard = F.greatest(F.lit(shard_words), F.ceil(all_words / shards))
    parts = F.greatest(F.ceil(F.col("source_size") / per_shard), F.lit(1)).cast("int")
    sources = sources.withColumns({"block": F.coalesce(block, F.lit(1)), "parts": parts})
    sources = sources.withColumns(
        {
            "blocks": F.ceil(F.col("source_size") / F.col("block")),
            "seats": F.round(F.sum("target").over(Window.partitionBy()) / F.col("block")).cast("bigint"),
        }
    ).withColumns({"limit": F.col("blocks") * most, "one": F.lit(1)})
    sources = apportion(sources, ["one"], [F.asc_nulls_last("source")], "target", "seats", "limit")
    sources = scratch.keep(sources.select("source", "source_size", "target", "block", "parts", "quota"))

    known = sources.select(F.col("source").alias("_source"), "source_size", "target", "block", "parts")
    placed = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("shard", F.pmod("place", "parts").cast("int"))
    placed = scratch.keep(placed)
    cut = placed.groupBy("source", "shard", "block").agg(F.sum("size").alias("words"))
    cut = cut.withColumns({"blocks": F.ceil(F.col("words") / F.col("block")), "limit": F.ceil(F.col("words") / F.col("block")) * most})
    quotas = sources.select(F.col("source").alias("_source"), F.col("quota").alias("seats"))
    cut = cut.join(quotas, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    cut = apportion(cut, ["source"], [F.asc("shard")], "words", "seats", "limit")
    first = F.when(F.col("blocks") > 0, F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), "blocks")).otherwise(0)
    cut = cut.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "blocks", "quota", first.alias("first")
    )

    met = placed.join(cut, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    in_shard = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size")
    end = F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0))
    laid = met.withColumns({"end": end}).withColumn("begin", F.col("end") - F.col("size"))
    blocks = F.greatest("blocks", F.lit(1))
    rounds, extra = F.floor(F.col("quota") / blocks), F.col("quota") % blocks
    run = F.col("first") + extra
    over = F.greatest(run - blocks, F.lit(0))
    low, high = F.col("first") * F.col("block"), F.least(run, blocks) * F.col("block")
    more = _overlap(F.col("begin"), F.col("end"), low, high)
    more = more + _overlap(F.col("begin"), F.col("end"), F.lit(0), over * F.col("block"))
    taken = (rounds * F.col("size") + more).cast("bigint").alias("taken")
    return laid.select("doc_id", "size", "source_size", "target", taken, "source", "shard", "place")


def mixed_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """Every row as often as the mix takes it, to the nearest whole number of times.

    Rows go by id and text: others of their id, or without one, count for themselves. Of rows
    alike in both each follows as often as the one taken most. Rows without words are not taken.
    """
    found = mix(docs, seed=seed, **options)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    found = stored(found.groupBy("doc_id", "place").agg(F.max(times).alias("__times")).filter("__times > 0"))
    if found.count() <= BROADCAST_IDS:
        found = F.broadcast(found)
    found = found.withColumnsRenamed({"doc_id": "__id", "place": "__place"})
    rows = docs.withColumn("__at", _place(seed))
    own = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__at") == F.col("__place")))
    return own.withColumn("__turn", F.explode(F.sequence(F.lit(1), "__times"))).select(*docs.columns)
