"""Arrays of fixed size, one from every task, added up without gathering them.

Each array travels in blocks, which are added up in levels: the parts of so many neighbouring
tasks first, then so many of these sums, so that no task gets more than a few of them. Parts
are added in the order of their tasks: the same split of the rows gives the same sum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = 16
# A task adds up the parts of 2 ** WIDTH others, in LEVELS; a last level adds the rest.
WIDTH = 6
LEVELS = 2
_SHAPE = "block int, part int, sums binary"


def _batch(blocks: list[int], part: list[int], sums: list[bytes]) -> pa.RecordBatch:
    arrays = [pa.array(blocks, pa.int32()), pa.array(part, pa.int32()), pa.array(sums, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["block", "part", "sums"])


def _level(parts: DataFrame, shift: int | None, kind: type = np.float64) -> DataFrame:
    """One sum for each block and group of parts (numbers of this kind); without a shift, of
    all parts."""
    group = F.lit(0) if shift is None else F.shiftright("part", shift)
    dealt = parts.withColumn("group", group).repartition("block", "group").sortWithinPartitions("block", "group", "part")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(0)
        for batch in batches:
            for block, group, data in zip(*(batch.column(c).to_pylist() for c in ("block", "group", "sums"))):
                values = np.frombuffer(data, kind).astype(np.float64)
                if key == (block, group):
                    total = total + values
                    continue
                if key is not None:
                    yield _batch([key[0]], [key[1]], [total.tobytes()])
                key, total = (block, group), values
        if key is not None:
            yield _batch([key[0]], [key[1]], [total.tobytes()])

    return dealt.mapInArrow(add, _SHAPE)


def totals(
    rows: DataFrame, of: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], kind: type = np.float64
) -> np.ndarray | None:
    """The sum over all partitions of what `of` makes of a partition; None if of nothing.

    A partition's numbers travel as of this kind. The size of the array bounds what the driver
    and any task gets.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = of(batches)
        if values is not None:
            parts = [x.astype(kind).tobytes() for x in np.array_split(values, BLOCKS)]
            yield _batch(list(range(BLOCKS)), [TaskContext.get().partitionId()] * BLOCKS, parts)

    parts = _level(rows.mapInArrow(part, _SHAPE), WIDTH, kind)
    for _ in range(LEVELS - 1):
        parts = _level(parts, WIDTH)
    found = _level(parts, None).collect()
    if not found:
        return None
    return np.concatenate([np.frombuffer(r["sums"]) for r in sorted(found, key=lambda r: r["block"])])
