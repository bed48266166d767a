"""Filter interaction audit: truth-table survival words and carry-save positional popcounts.

Five filters judge each document; what it fails is a set of at most five letters. Its survival
word has a bit for each of the 32 subsets of filters, set if the document passes all filters of
the subset. Adding the words up position by position, by carry-save adders, tells how many
documents survive each subset; for each part, and for the good and the toxic documents in it,
these 32 numbers answer every order of the filters at every step.

Fails A: fewer than 200 words; B: fewer than half as many distinct words as words; C: more than
3 of 100 code points in A-Z; D: any of # $ % & * |; E: the text of a smaller id, anywhere in the
table. Words are runs of other than space, tab, line feed, vertical tab, form feed and carriage
return, as they are spelled.

A null text is empty (and equal to other empty ones), a null part the empty string. Every row
counts, also repeated ones: rows of one id are not smaller than each other. A row without an id
is neither smaller nor greater, so it never fails E, and has no label; ids labelled more than
once are good or toxic if any label says so. An empty table gives no row. Texts are compared by
128 bits of their SHA-256. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstar.llm.words import Texts, texts
from shopstar.sources.scratch import Scratch, stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
SIGNS = "#$%&*|"
# Rows that a task adds up at a time.
ROWS = 1 << 18
# Survival word of each set of failed filters.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & fails) for fails in range(SUBSETS)], np.uint32)
_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS.encode())] = True


def failures(part: Texts) -> np.ndarray:
    """Which of A to D each text fails, as bits from A on."""
    first, words = part.first, part.hashes()
    n_words = np.diff(first)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(first[:-1], first[1:])], np.int64)

    def per_text(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(marks))[part.bounds])

    capitals = per_text((part.data >= 65) & (part.data <= 90))
    points = per_text(part.data & 0xC0 != 0x80)
    fails = [
        n_words < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n_words,
        100 * capitals > MOST_CAPITALS * points,
        per_text(_SIGN[part.data]) > 0,
    ]
    return sum(f.astype(np.int8) << i for i, f in enumerate(fails))


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of 32 bits set.

    Three words of a weight become one of that weight and one of twice it, until at most two
    of each weight are left to be read bit by bit.
    """
    counts, weight, place = np.zeros(32, np.int64), 1, np.arange(32, dtype=np.uint32)
    while len(words):
        carried = [words[:0]]
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            odd = a ^ b
            carried.append(a & b | odd & c)
            words = np.concatenate([odd ^ c, words[3 * third :]])
        counts += weight * (words[:, None] >> place & 1).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carried), 2 * weight
    return counts


def judged(docs: DataFrame, part: str = "lang", key: str = "doc_id") -> DataFrame:
    """id, part, the bits of A to D, and a digest of the text, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [np.zeros(0, np.int8)], []
            for _, some in texts(batch.column(2)):
                fails.append(failures(some))
                cuts = some.bounds.tolist()
                digests += [hashlib.sha256(some.data[a:b]).digest()[:16] for a, b in zip(cuts, cuts[1:])]
            arrays = [batch.column(0), batch.column(1), pa.array(np.concatenate(fails), pa.int8()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "part", "fails", "digest"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"id {kind}, part string, fails tinyint, digest binary")


def survivors(rows: DataFrame) -> DataFrame:
    """part, subset, and the documents, good ones and toxic ones that pass all of the subset.

    rows: part, fails (bits of failed filters), good, toxic.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= ROWS:
                yield added(held)
                held = []
        if sum(map(len, held)):
            yield added(held)

    def added(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        names = table["part"].combine_chunks().dictionary_encode()
        code = names.indices.to_numpy()
        words = WORDS[table["fails"].to_numpy()]
        good, toxic = (table[c].to_numpy(zero_copy_only=False) for c in ("good", "toxic"))
        order = np.argsort(code, kind="stable")
        cuts = np.searchsorted(code[order], np.arange(len(names.dictionary) + 1))
        sums = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = order[a:b]
            sums.append([positional_popcount(words[x]) for x in (own, own[good[own]], own[toxic[own]])])
        by_column = np.array(sums).transpose(1, 0, 2).reshape(3, -1)
        part = names.dictionary.take(pa.array(np.repeat(np.arange(len(sums)), SUBSETS)))
        subset = pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(sums)))
        return pa.RecordBatch.from_arrays([part, subset, *map(pa.array, by_column)], ["part", "subset", "n", "good", "toxic"])

    counted = rows.select("part", "fails", "good", "toxic").mapInArrow(run, "part string, subset int, n bigint, good bigint, toxic bigint")
    return counted.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _orders() -> list[dict]:
    """Every step of every order: its filter's bit, and the bits of those before it."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            steps.append({"filter_order": "".join(order), "step": step, "filter": letter, "own": own, "before": before})
            before |= own
    return steps


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, filter_order, step, filter, and the counts that its step of that order gives.

    labels: doc_id, quality and toxic. 600 rows for each part that documents have.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.keep(judged(docs, part))
        # Only texts that occur twice can fail E; the least id decides for all copies.
        firsts = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        firsts = firsts.filter("least < most").select("digest", "least")
        known = labels.groupBy(F.col("doc_id").alias("id")).agg(
            F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
        )
        rows = rows.join(firsts, "digest", "left").join(known, "id", "left")
        last = F.when(F.col("least") < F.col("id"), 1 << FILTERS.index("E")).otherwise(0)
        no = F.lit(False)
        marked = rows.select("part", (F.col("fails") + last).cast("int").alias("fails"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
        counts = stored(survivors(marked))
    return _by_order(counts)


def _by_order(counts: DataFrame) -> DataFrame:
    # Exactly 32 rows of a part meet in its list.
    lists = counts.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("of"))
    shape = "array<struct<filter_order: string, step: int, filter: string, own: int, before: int>>"
    steps = lists.select("part", "of", F.inline(F.from_json(F.lit(json.dumps(_orders())), shape)))
    whole = SUBSETS - 1
    at = lambda subset, count: F.element_at("of", (subset + 1).cast("int"))[count]
    own, before = F.col("own"), F.col("before")
    lost = lambda count: at(before, count) - at(before + own, count)
    steps = steps.select(
        "part",
        "filter_order",
        "step",
        "filter",
        at(before + own, "n").alias("kept"),
        lost("n").alias("removed"),
        (at(F.lit(0), "n") - at(own, "n") - lost("n")).alias("redundant"),
        (at(whole - own, "n") - at(F.lit(whole), "n")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
    )
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))
