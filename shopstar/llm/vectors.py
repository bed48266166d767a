"""Vectors in shards cut by place, and queries sent to the shards that may hold their best.

A row takes part if its id and its vector are there and all components are finite numbers.
Vectors of different lengths never meet. Rows alike in id and vector count once. An id may
have several vectors: as a candidate it has the best of their scores and one place, as a
query it searches with each.

Every vector goes to the cell of the nearest of a few pivots, a cell of many rows is dealt out
over shards by hash, and a shard travels as one packed row. Of each shard there is a summary,
from which the best score that a query can reach in it is bounded. A query first searches the
shard of the best bound. After that it is sent to those shards only whose bound its k-th best
score does not exceed, in blocks, so that shards and queries meet in groups of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.sources.scratch import Scratch, stored

# Rows of a shard; more where there would be over MAX_SHARDS of them (besides one for each
# cell and length of vectors), since the summaries of all are broadcast.
SHARD_ROWS = 8192
MAX_SHARDS = 1 << 14
BLOCK_ROWS = 4096
PIVOTS = 64
# Bounds worked out at a time, and how far a floor lies below a score, for rounding's sake.
BOUNDS = 1 << 21
MARGIN = 1e-12


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Columns id, vec (doubles) and dim of the rows that take part, each once."""
    one = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = one.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & sound)
    return kept.dropDuplicates(["id", "vec"]).withColumn("dim", F.size("vec"))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A column of vectors of one length, a row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def arrays(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(data, np.float64).reshape(-1, dim)


def _celled(rows: DataFrame, pivots: int) -> DataFrame:
    """With `cell`, the pivot of the same length that is nearest by angle.

    Pivots are rows drawn by a hash, at most so many; the driver gets no others.
    """
    drawn = rows.orderBy(F.xxhash64("vec"), "id").limit(pivots).collect()
    of: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in drawn}:
        found = np.unique(np.array([r["vec"] for r in drawn if r["dim"] == dim]), axis=0)
        lengths = np.sqrt((found * found).sum(axis=1))
        of[dim] = found / np.where(lengths > 0, lengths, 1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            cell = np.zeros(len(batch), np.int32)
            for dim in np.unique(dims):
                if dim in of:
                    at = np.flatnonzero(dims == dim)
                    cell[at] = np.argmax(matrix(batch.column(1).take(pa.array(at)), int(dim)) @ of[dim].T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["id", "vec", "dim", "cell"])

    return rows.select("id", "vec", "dim").mapInArrow(run, "id bigint, vec array<double>, dim int, cell int")


def sharded(rows: DataFrame, shard_rows: int, summary: Callable[[np.ndarray], bytes], scratch: Scratch, pivots: int = PIVOTS) -> DataFrame:
    """shard, dim, ids, data and summary of every shard, a row each; stored."""
    placed = scratch.keep(_celled(rows, pivots))
    sizes = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("size"))
    total = placed.count()
    per_shard = max(shard_rows, -(-total // MAX_SHARDS))
    deal = F.pmod(F.xxhash64("id", "vec"), F.ceil(F.col("size") / per_shard))
    shard = F.concat_ws("/", "dim", "cell", deal).alias("shard")

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        dim = table["dim"][0].as_py()
        values = matrix(table["vec"], dim)
        ids = table["id"].to_numpy()
        row = {"shard": [table["shard"][0].as_py()], "dim": [dim], "ids": [ids.tobytes()], "data": [np.ascontiguousarray(values).tobytes()], "summary": [summary(values)]}
        return pa.table(row, schema=pa.schema([("shard", pa.string()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("summary", pa.binary())]))

    dealt = placed.join(sizes, ["dim", "cell"]).select(shard, "id", "vec", "dim")
    packed = dealt.groupBy("shard").applyInArrow(pack, "shard string, dim int, ids binary, data binary, summary binary")
    return scratch.keep(packed)


@dataclass
class Route:
    """Which shards queries go to. bounds(queries, summaries) gives the best score that each
    query can reach in each shard."""

    names: dict[int, list[str]]
    summaries: dict[int, np.ndarray]
    bounds: Callable[[np.ndarray, np.ndarray], np.ndarray]

    @classmethod
    def over(cls, shards: DataFrame, bounds: Callable) -> Route:
        names: dict[int, list[str]] = {}
        held: dict[int, list[np.ndarray]] = {}
        for r in shards.select("shard", "dim", "summary").collect():
            names.setdefault(r["dim"], []).append(r["shard"])
            held.setdefault(r["dim"], []).append(np.frombuffer(r["summary"]))
        return cls(names, {dim: np.stack(x) for dim, x in held.items()}, bounds)


_ASKED = "id bigint, vec array<double>, dim int, floor double"


def _sent(asked: DataFrame, route: Route, home: bool) -> DataFrame:
    """A row for each query and each shard it goes to: with `home` the one of the best bound,
    else all others whose bound is not below the query's floor."""
    held = asked.sparkSession.sparkContext.broadcast(route)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route = held.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                if int(dim) not in route.names:
                    continue
                shards = pa.array(route.names[int(dim)])
                at = np.flatnonzero(dims == dim)
                for some in np.array_split(at, len(at) * len(shards) // BOUNDS + 1):
                    own = batch.take(pa.array(some))
                    reach = route.bounds(matrix(own.column("vec"), int(dim)), route.summaries[int(dim)])
                    best = np.argmax(reach, axis=1)
                    if home:
                        query, shard = np.arange(len(own)), best
                    else:
                        wanted = reach >= own.column("floor").to_numpy()[:, None]
                        wanted[np.arange(len(own)), best] = False
                        query, shard = np.nonzero(wanted)
                    columns = [shards.take(pa.array(shard)), *own.take(pa.array(query)).columns]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", *own.schema.names])

    return asked.select("id", "vec", "dim", "floor").mapInArrow(run, f"shard string, {_ASKED}")


def _met(shards: DataFrame, sent: DataFrame, find: Callable, kind: str, block_rows: int) -> DataFrame:
    """query_id, vec_id, score and the query's vector, of what `find` finds in each shard.

    find(shard row, ids, vectors, floors) gives the place of the query among these, the
    vector's id and the score. The queries of a shard are packed in blocks of about
    block_rows; a shard is copied for each block and for nothing else.
    """
    counts = sent.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / block_rows))
    block = F.pmod(F.xxhash64("id", "vec"), F.col("blocks"))
    asked = sent.join(counts, "shard").select("shard", block.alias("block"), "id", "vec", "dim", "floor")

    def pack(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        row = [table["shard"][0].as_py(), table["block"][0].as_py(), table["id"].to_numpy().tobytes(), np.ascontiguousarray(matrix(table["vec"], dim)).tobytes(), table["floor"].to_numpy().tobytes()]
        names, kinds = ["shard", "block", "q_ids", "q_data", "floors"], [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array([x], k) for x, k in zip(row, kinds)], names)

    blocks = asked.groupBy("shard", "block").applyInArrow(pack, "shard string, block bigint, q_ids binary, q_data binary, floors binary")
    pairs = shards.drop("summary").join(counts, "shard").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    pairs = pairs.drop("n", "blocks").join(blocks.hint("merge"), ["shard", "block"])
    names = pairs.columns
    score = pa.int64() if kind == "bigint" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = {name: batch.column(i)[at].as_py() for i, name in enumerate(names)}
                ids, wanted = arrays(row["q_ids"], row["q_data"], row["dim"])
                query, found, scores = find(row, ids, wanted, np.frombuffer(row["floors"]))
                vec = pa.FixedSizeListArray.from_arrays(pa.array(wanted[query].ravel()), row["dim"]).cast(pa.list_(pa.float64()))
                columns = [pa.array(ids[query]), pa.array(found, pa.int64()), pa.array(scores, score), vec]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score", "vec"])

    return pairs.mapInArrow(run, f"query_id bigint, vec_id bigint, score {kind}, vec array<double>")


def searched(
    shards: DataFrame, asked: DataFrame, bounds: Callable, find: Callable, kind: str, k: int, block_rows: int, scratch: Scratch
) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of each query id over all shards.

    shards: as sharded, with further columns for `find`; asked: as usable.
    """
    route = Route.over(shards, bounds)
    first = asked.withColumn("floor", F.lit(float("-inf")))
    near = scratch.keep(_met(shards, _sent(first, route, home=True), find, kind, block_rows))
    by_vector = Window.partitionBy("query_id", "vec").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("rank", F.row_number().over(by_vector)).filter(F.col("rank") == k)
    score = F.col("score").cast("double")
    kth = kth.select(F.col("query_id").alias("id"), "vec", (score - F.abs(score) * MARGIN).alias("floor"))
    known = asked.join(kth, ["id", "vec"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    far = _met(shards, _sent(known, route, home=False), find, kind, block_rows)
    found = near.union(far).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return stored(ranked.select("query_id", "rank", "vec_id", "score"))


def best_of_each(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids of each query, each with its best score, ties to the smaller id."""
    order = np.lexsort((-scores, ids, query))
    query, ids, scores = query[order], ids[order], scores[order]
    own = np.ones(len(query), bool)
    own[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
    query, ids, scores = query[own], ids[own], scores[own]
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query, side="left") < k
    return query[keep], ids[keep], scores[keep]


def asked_of(usable_rows: DataFrame, is_query: Column, scratch: Scratch) -> DataFrame:
    return scratch.keep(usable_rows.filter(is_query))


def multiplicity(ids: np.ndarray) -> int:
    """The most rows that one id has."""
    return int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else 1


