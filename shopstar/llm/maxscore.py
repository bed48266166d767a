"""Exact top-k by inner product of integer vectors, with MaxScore over sharded postings.

A term is a component with a sign. Its posting list in a shard holds the vectors whose
component has that sign, with the magnitudes. A query's term of equal sign adds to a score,
at most the query's weight times the list's largest magnitude; terms of the other sign only
take away. The weakest terms whose bounds together stay below the threshold are not
essential: a vector on their lists alone cannot reach the k best. The essential lists are
traversed; the other terms are probed, strongest first, for vectors that can still reach
the threshold; what remains is scored exactly. Vectors on no essential list are looked at
only when they are needed to fill the k places. Shards' results merge by rank; a shard whose
largest magnitudes cannot bring a query to its threshold is not sent to it.

Rows with a null id, or a vector that is null, empty, or holds null or non-finite
components, take no part. Rows alike in id and vector count once; an id of several vectors
has the best of their scores, and as a query searches with each. Equal scores rank by the
smaller id. A query never finds rows of its own id. With fewer than k candidates all are
returned. Scores are exact: sums run in double precision where that holds them, else in whole
numbers of any size; beyond the range of a long a score is the end of that range.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.llm import vectors
from shopstar.sources.scratch import Scratch

LONG = (1 << 63) - 1
EXACT = 1 << 53


def products(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, exact, as int64."""
    most = float(np.abs(values).max(initial=0)) * float(np.abs(query).max(initial=0)) * len(query)
    if most < EXACT:
        return (values @ query).astype(np.int64)
    if most < LONG:
        return values.astype(np.int64) @ query.astype(np.int64)
    asked = [int(x) for x in query]
    sums = [sum(int(x) * y for x, y in zip(row, asked)) for row in values]
    return np.array([min(max(x, -LONG - 1), LONG) for x in sums], np.int64)


def summary(values: np.ndarray) -> bytes:
    """The largest magnitude of each term: positive components, then negative ones."""
    return np.concatenate([np.maximum(values.max(axis=0), 0), np.maximum((-values).max(axis=0), 0)]).tobytes()


def bounds(queries: np.ndarray, summaries: np.ndarray) -> np.ndarray:
    """No score of a query in a shard is above this: its terms at their largest."""
    terms = np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], axis=1)
    with np.errstate(over="ignore"):
        return (terms @ summaries.T) * (1 + 1e-9)


class Shard:
    """Posting lists of one shard, by component and sign."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids = ids
        self.values = values
        self.size = len(ids)
        # So many best rows have k different ids among them.
        self.many = vectors.multiplicity(ids)
        self.lists = {}
        for d in range(values.shape[1]):
            for sign in (1, -1):
                amounts = values[:, d] * sign
                rows = np.flatnonzero(amounts > 0)
                rows = rows[np.argsort(-amounts[rows], kind="stable")]
                self.lists[d, sign] = rows, amounts[rows]

    def best(self, query_id: int, query: np.ndarray, k: int, floor: float = float("-inf")) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows that are not the query's own, none below floor."""
        terms = []
        for d in np.flatnonzero(query):
            sign = 1 if query[d] > 0 else -1
            rows, amounts = self.lists[d, sign]
            if len(rows):
                terms.append((abs(query[d]) * amounts[0], abs(query[d]), d, sign))
        terms.sort()
        own = self.ids == query_id
        floor = max(floor, self._first_threshold(query, terms, own, k * self.many))
        reach = np.cumsum([t[0] for t in terms]) if terms else np.zeros(0)
        # Room for the rounding of sums that double precision does not hold.
        if len(reach) and reach[-1] >= EXACT:
            floor -= reach[-1] * vectors.MARGIN
        # Sums below the threshold: even all these terms together do not reach it.
        weak = int(np.searchsorted(reach, floor, side="left")) if floor > 0 else 0
        if floor <= 0:
            # Every vector may be among the k best: all lists count, and the unlisted too.
            candidates = np.flatnonzero(~own)
        else:
            sums = np.zeros(self.size)
            for _, weight, d, sign in terms[weak:]:
                rows, amounts = self.lists[d, sign]
                sums[rows] += weight * amounts
            candidates = np.flatnonzero((sums > 0) & ~own)
            sums = sums[candidates]
            for at in range(weak - 1, -1, -1):
                able = sums + reach[at] >= floor
                candidates, sums = candidates[able], sums[able]
                _, weight, d, sign = terms[at]
                sums = sums + weight * np.maximum(self.values[candidates, d] * sign, 0)
            candidates = candidates[sums >= floor]
        scores = products(self.values[candidates], query)
        places = k * self.many
        if len(scores) > places:
            least = np.partition(scores, len(scores) - places)[len(scores) - places]
            candidates, scores = candidates[scores >= least], scores[scores >= least]
        _, ids, scores = vectors.best_of_each(np.zeros(len(scores), np.int64), self.ids[candidates], scores, k)
        return ids, scores

    def _first_threshold(self, query, terms, own, places: int) -> float:
        """A score that so many of the heads of the strongest lists reach."""
        heads = [self.lists[d, sign][0][: 2 * places] for _, _, d, sign in terms[-8:]]
        rows = np.unique(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
        rows = rows[~own[rows]]
        if len(rows) < places:
            return float("-inf")
        scores = self.values[rows] @ query
        return float(np.partition(scores, len(rows) - places)[len(rows) - places])


def search(
    rows: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding",
    shard_rows: int = vectors.SHARD_ROWS, block_rows: int = vectors.BLOCK_ROWS,
) -> DataFrame:
    """The k best rows for every query row: query_id, rank from 1, vec_id, score.

    is_query: condition over the column `id`. Components count as floor(scale * x).
    """
    one = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    # Of a whole number that double precision holds, nothing is to be rounded off.
    def floored(x: Column) -> Column:
        scaled = x * F.lit(float(scale))
        return F.when(F.abs(scaled) < float(EXACT), F.floor(scaled).cast("double")).otherwise(scaled)

    whole = one.withColumn("vec", F.transform("vec", floored))

    def find(row: dict, asked: np.ndarray, wanted: np.ndarray, floors: np.ndarray):
        shard = Shard(*vectors.arrays(row["ids"], row["data"], row["dim"]))
        found = [shard.best(i, q, k, f) for i, q, f in zip(asked, wanted, floors)]
        query = np.repeat(np.arange(len(asked)), [len(x[0]) for x in found])
        return query, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    with Scratch(rows.sparkSession) as scratch:
        known = scratch.keep(vectors.usable(whole, "id", "vec"))
        shards = vectors.sharded(known, shard_rows, summary, scratch)
        asked = vectors.asked_of(known, is_query, scratch)
        return vectors.searched(shards, asked, bounds, find, "bigint", k, block_rows, scratch)
