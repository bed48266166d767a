"""Approximate nearest neighbours by cosine: a vantage-point tree per shard.

On unit vectors the chord length orders like the cosine and obeys the triangle inequality.
A tree node splits its points at the median distance from a vantage point. A query skips a
side when the gap between its distance and the split exceeds its present k-th distance
divided by the factor `relax`: at 1 nothing nearer can be missed and the search is exact;
above 1 more is skipped. A block of queries goes down a tree together: first each to its
own leaf for a first k-th distance, then all through the whole tree with pruning.

The index is a stored table with every usable row in one tree. Trees cover a region each: a
shard's summary is the mean direction of its vectors and how far they lie from it at most. A
tree is not sent to a query if the gap to its region exceeds the query's present k-th
distance divided by `relax`, by the same inequality.

Zero vectors, null ids and vectors that are null, empty, or hold null or non-finite
components take no part. Rows alike in id and vector count once; an id of several vectors has
the best of their scores, and as a query searches with each. Scores are cosines in double
precision over the original vectors; ties go to the smaller id. A query never finds rows of
its own id. With fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.llm import vectors
from shopstar.sources.scratch import Scratch

LEAF_ROWS = 48
# Room for rounding when unit vectors are compared; exact scores decide afterwards.
SLACK = 1e-9


def _units(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(axis=1))[:, None]


def build(values: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and nodes (begin, end, inner, outer, vantage row, split).

    Children are node numbers, -1 at leaves. Vantage points stay among the rows of their
    node; the one chosen is the farthest from the node's first row, as edge points split best.
    """
    units = _units(values)
    order = np.arange(len(values))
    nodes: list[list[float]] = []

    def grow(begin: int, end: int) -> int:
        number = len(nodes)
        nodes.append([begin, end, -1, -1, -1, 0.0])
        if end - begin <= leaf_rows:
            return number
        own = order[begin:end]
        vantage = own[np.argmin(units[own] @ units[own[0]])]
        apart = np.sqrt(np.maximum(2 - 2 * (units[own] @ units[vantage]), 0))
        sorted_rows = np.argsort(apart, kind="stable")
        order[begin:end] = own[sorted_rows]
        middle = (end - begin) // 2
        split = apart[sorted_rows[middle - 1]]
        nodes[number][4:] = [int(vantage), float(split)]
        nodes[number][2] = grow(begin, begin + middle)
        nodes[number][3] = grow(begin + middle, end)
        return number

    grow(0, len(values))
    return order, np.array(nodes, np.float64)


class Tree:
    def __init__(self, ids: np.ndarray, values: np.ndarray, order: np.ndarray, nodes: np.ndarray):
        self.ids, self.values, self.order, self.nodes = ids, values, order, nodes
        self.units = _units(values)
        self.rows = self.units[order]

    def best(self, asked: np.ndarray, wanted: np.ndarray, k: int, relax: float, floors: np.ndarray | None = None):
        """Places of queries, row ids and cosines of the k nearest found for each query.

        floors: cosines that k rows elsewhere are known to reach.
        """
        units = _units(wanted)
        # So many best rows have k different ids among them.
        places = min(k * vectors.multiplicity(self.ids), len(self.ids))
        self.asked, self.wanted, self.k, self.relax = asked, units, places, relax
        self.top = np.full((len(asked), places), -np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self._descend(0, np.arange(len(asked)))
        first = self.top[:, 0].copy()
        self.top = np.full((len(asked), places), -np.inf)
        self.known = first if floors is None else np.maximum(first, floors)
        self.found.clear()
        self._visit(0, np.arange(len(asked)))
        return self._exact(wanted, k)

    def _leaf(self, node, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, end = int(node[0]), int(node[1])
        near = self.wanted[queries] @ self.rows[begin:end].T
        near[self.asked[queries][:, None] == self.ids[self.order[begin:end]][None, :]] = -np.inf
        both = np.concatenate([self.top[queries], near], axis=1)
        both.partition(both.shape[1] - self.k, axis=1)
        both = both[:, -self.k :]
        both.sort(axis=1)
        self.top[queries] = both
        return near, np.arange(begin, end)

    def _apart(self, node, queries: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (self.wanted[queries] @ self.units[int(node[4])]), 0))

    def _descend(self, number: int, queries: np.ndarray) -> None:
        """Each query to the leaf on its own side of every split."""
        if not len(queries):
            return
        node = self.nodes[number]
        if node[2] < 0:
            self._leaf(node, queries)
            return
        inner = self._apart(node, queries) <= node[5]
        self._descend(int(node[2]), queries[inner])
        self._descend(int(node[3]), queries[~inner])

    def _reach(self, queries: np.ndarray) -> np.ndarray:
        """Distance to the k-th nearest known so far."""
        cosine = np.maximum(self.top[queries, 0], self.known[queries])
        return np.sqrt(np.maximum(2 - 2 * np.maximum(cosine, -1), 0)) + SLACK

    def _visit(self, number: int, queries: np.ndarray) -> None:
        if not len(queries):
            return
        node = self.nodes[number]
        if node[2] < 0:
            near, rows = self._leaf(node, queries)
            least = np.maximum(self.top[queries, 0], self.known[queries])
            at, which = np.nonzero((near >= least[:, None] - SLACK) & (near > -np.inf))
            self.found.append((queries[at], self.order[rows[which]]))
            return
        apart = self._apart(node, queries)
        self._visit(int(node[2]), queries[apart - node[5] <= self._reach(queries) / self.relax])
        self._visit(int(node[3]), queries[node[5] - apart <= self._reach(queries) / self.relax])

    def _exact(self, wanted: np.ndarray, k: int):
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query = np.concatenate([x[0] for x in self.found])
        row = np.concatenate([x[1] for x in self.found])
        a, b = wanted[query], self.values[row]
        lengths = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
        cosine = (a * b).sum(axis=1) / lengths
        return vectors.best_of_each(query, self.ids[row], cosine, k)


def summary(values: np.ndarray) -> bytes:
    """The mean direction, how far units lie from it at most."""
    units = _units(values)
    centre = units.mean(axis=0)
    apart = np.sqrt(((units - centre) ** 2).sum(axis=1)).max()
    return np.append(centre, apart).tobytes()


def bounds(queries: np.ndarray, summaries: np.ndarray, relax: float) -> np.ndarray:
    """The best cosine that each query is taken to reach in each shard, by its region."""
    units, centres, widths = _units(queries), summaries[:, :-1], summaries[:, -1]
    square = 1 + (centres * centres).sum(axis=1) - 2 * units @ centres.T
    gap = np.maximum(np.sqrt(np.maximum(square, 0)) - widths - SLACK, 0) * relax
    return 1 - gap * gap / 2


def index(rows: DataFrame, scratch: Scratch, shard_rows: int = vectors.SHARD_ROWS) -> DataFrame:
    """Stored trees over every row, one of each shard with its summary.

    rows: as `directed` gives them.
    """
    shards = vectors.sharded(rows, shard_rows, summary, scratch)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                _, values = vectors.arrays(row.column(2)[0].as_py(), row.column(3)[0].as_py(), row.column(1)[0].as_py())
                order, nodes = build(values)
                made = [pa.array([order.astype(np.int64).tobytes()]), pa.array([nodes.tobytes()])]
                yield pa.RecordBatch.from_arrays([*row.columns, *made], [*row.schema.names, "tree_order", "nodes"])

    shape = "shard string, dim int, ids binary, data binary, summary binary, tree_order binary, nodes binary"
    return scratch.keep(shards.mapInArrow(grow, shape))


def directed(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """The usable rows whose vectors have a direction."""
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    return vectors.usable(rows, key, vector).filter(length > 0)


def search(
    rows: DataFrame, is_query: Column, k: int = 5, relax: float = 1.0, key: str = "vec_id", vector: str = "embedding",
    shard_rows: int = vectors.SHARD_ROWS, block_rows: int = vectors.BLOCK_ROWS,
) -> DataFrame:
    """The k nearest rows found for every query row: query_id, rank from 1, vec_id, score.

    is_query: condition over the column `id`.
    """

    def find(row: dict, asked: np.ndarray, wanted: np.ndarray, floors: np.ndarray):
        ids, values = vectors.arrays(row["ids"], row["data"], row["dim"])
        order = np.frombuffer(row["tree_order"], np.int64)
        nodes = np.frombuffer(row["nodes"], np.float64).reshape(-1, 6)
        return Tree(ids, values, order, nodes).best(asked, wanted, k, relax, floors)

    with Scratch(rows.sparkSession) as scratch:
        known = scratch.keep(directed(rows, key, vector))
        trees = index(known, scratch, shard_rows)
        asked = vectors.asked_of(known, is_query, scratch)
        return vectors.searched(trees, asked, partial(bounds, relax=relax), find, "double", k, block_rows, scratch)
