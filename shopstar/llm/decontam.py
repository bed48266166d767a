"""Benchmark decontamination: Wu-Manber search for windows of benchmark items, over words.

A word is a run of bytes other than ASCII that is neither letter nor digit, A-Z as a-z. Each
item gives its windows of `size` consecutive words; an item of fewer words is one window, one
without words none. Texts are searched for all windows at once. Windows of one length share a
table. It knows, of any block of two words, how far a window that goes on behind the block can
be away at least; the search jumps by that much. Where it need not move, the first and last
blocks name a bucket of windows, and these are compared with the text directly, word by word
and byte by byte.

The items are dealt out over shards of at most `shard_bytes` of text (a longer item is a shard
alone), one table of which is broadcast at a time; with more than one shard every document
carries what it has so far from round to round, through written tables.

Null and empty texts have no words. Rows of documents may repeat or lack an id: each is judged
by itself. Items may repeat, and share windows; an item without an id is searched for and
marks words, but is not listed. Empty tables give no row, or no hit. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.words import FOLDED, Texts, mix, spans_hash, texts
from shopstar.sources.scratch import Scratch, stored

SIZE = 10
SHARD_BYTES = 4 << 20
BLOCK = 2
# A text is searched in stretches of so many words side by side.
STRETCH = 256
COMPARED_BYTES = 1 << 20
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Table:
    """All distinct windows of one length."""

    size: int
    shift: np.ndarray
    # Hash of first and last block, in order, and the item word each window begins at.
    keys: np.ndarray
    begin: np.ndarray
    # Items of window i: items[first_item[i] : first_item[i + 1]].
    items: np.ndarray
    first_item: np.ndarray

    def slots(self, last: np.ndarray) -> np.ndarray:
        return (last % np.uint64(len(self.shift))).astype(np.int64)


def _blocks(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of words that ends at each place."""
    if size < BLOCK:
        return hashes[at]
    return mix(hashes[at - 1] * _FACTOR + hashes[at])


def _keys(hashes: np.ndarray, begin: np.ndarray, size: int, last: np.ndarray) -> np.ndarray:
    return mix(_blocks(hashes, begin + min(size, BLOCK) - 1, size) * _FACTOR + last)


def _same_words(part: Texts, at: np.ndarray, other: Texts, begin: np.ndarray, size: int) -> np.ndarray:
    """Whether the words from each place on are the other's, byte by byte with A-Z as a-z."""
    step = np.arange(size)
    mine, theirs = at[:, None] + step, begin[:, None] + step
    long = part.ends[mine] - part.starts[mine]
    same = (long == other.ends[theirs] - other.starts[theirs]).all(axis=1)
    rows = np.flatnonzero(same)
    weight = np.cumsum(long[rows].sum(axis=1))
    while len(rows):
        cut = max(1, int(np.searchsorted(weight, COMPARED_BYTES + weight[0], side="right")))
        now, rows = rows[:cut], rows[cut:]
        weight = weight[cut:]
        sizes = long[now].ravel()
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        a = part.data[np.repeat(part.starts[mine[now]].ravel(), sizes) + place]
        b = other.data[np.repeat(other.starts[theirs[now]].ravel(), sizes) + place]
        owner = np.repeat(np.repeat(now, size), sizes)
        same[owner[FOLDED[a] != FOLDED[b]]] = False
    return same


class Patterns:
    """The windows of some items, ready to be searched for."""

    def __init__(self, ids: list, items: list[str | None], size: int = SIZE):
        names = [None if i is None else str(i) for i in ids]
        self.names = sorted({n for n in names if n is not None})
        place = {n: i for i, n in enumerate(self.names)}
        whole = [(t or "").encode() for t in items]
        bounds = np.cumsum([0, *map(len, whole)])
        self.part = Texts(np.frombuffer(b"".join(whole), np.uint8), bounds, BREAKS)
        self.hashes = self.part.hashes(fold=True)
        own = np.array([-1 if n is None else place[n] for n in names], np.int64)
        counts = np.diff(self.part.first)
        sizes = np.minimum(counts, size)
        windows = np.where(counts > 0, counts - sizes + 1, 0)
        begin = np.repeat(self.part.first[:-1], windows)
        begin += np.arange(len(begin)) - np.repeat(np.cumsum(windows) - windows, windows)
        sizes, owner = np.repeat(sizes, windows), np.repeat(own, windows)
        self.tables = [self._table(int(m), begin[sizes == m], owner[sizes == m]) for m in np.unique(sizes)]

    def _table(self, size: int, begin: np.ndarray, owner: np.ndarray) -> Table:
        last = _blocks(self.hashes, begin + size - 1, size)
        keys = _keys(self.hashes, begin, size, last)
        whole = spans_hash(self.hashes, begin, begin + size)
        order = np.lexsort((owner, whole, keys))
        begin, owner, keys, whole = begin[order], owner[order], keys[order], whole[order]
        # A window like the one before it is the same; should only their hashes be, it is its own.
        new = np.ones(len(begin), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (whole[1:] != whole[:-1])
        new[1:] |= ~_same_words(self.part, begin[1:], self.part, begin[:-1], size)
        group = np.cumsum(new) - 1
        listed = (owner >= 0) & (new | np.append(True, owner[1:] != owner[:-1]))
        first_item = np.searchsorted(group[listed], np.arange(new.sum() + 1))
        block = min(size, BLOCK)
        furthest = size - block + 1
        shift = np.full(1 << int(8 * furthest * max(new.sum(), 16)).bit_length(), furthest, np.uint8)
        table = Table(size, shift, keys[new], begin[new], owner[listed], first_item)
        for left in range(furthest - 1, -1, -1):
            shift[table.slots(_blocks(self.hashes, table.begin + size - 1 - left, size))] = left
        return table

    def _stops(self, table: Table, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places where a window may end: all that the jumps do not pass over."""
        begin, end = first[:-1] + table.size - 1, first[1:]
        stretches = np.maximum(-(-(end - begin) // STRETCH), 0)
        at = np.repeat(begin, stretches)
        at += STRETCH * (np.arange(len(at)) - np.repeat(np.cumsum(stretches) - stretches, stretches))
        stop = np.minimum(at + STRETCH, np.repeat(end, stretches))
        found = [at[:0]]
        while len(at):
            jump = table.shift[table.slots(_blocks(hashes, at, table.size))]
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            at, stop = at[at < stop], stop[at < stop]
        return np.concatenate(found)

    def search(self, part: Texts) -> Iterator[tuple[Table, np.ndarray, np.ndarray]]:
        """For each table the first word of each occurrence in the texts, and its window."""
        hashes = part.hashes(fold=True)
        for table in self.tables:
            end = self._stops(table, hashes, part.first)
            begin = end - table.size + 1
            keys = _keys(hashes, begin, table.size, _blocks(hashes, end, table.size))
            place = np.searchsorted(table.keys, keys)
            starts, found = [], []
            while len(place):
                live = place < len(table.keys)
                live[live] = table.keys[place[live]] == keys[live]
                begin, keys, place = begin[live], keys[live], place[live]
                same = _same_words(part, begin, self.part, table.begin[place], table.size)
                starts.append(begin[same])
                found.append(place[same])
                place = place + 1
            if starts:
                yield table, np.concatenate(starts), np.concatenate(found)

    def mark(self, part: Texts) -> tuple[np.ndarray, dict[int, list[str]]]:
        """Which words an occurrence covers, and the items found in each text with any."""
        edge = np.zeros(len(part.starts) + 1, np.int64)
        items: dict[int, set[int]] = {}
        for table, begin, window in self.search(part):
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + table.size, -1)
            text = np.searchsorted(part.first, begin, side="right") - 1
            order = np.lexsort((window, text))
            text, window = text[order], window[order]
            cuts = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else []
            for a, b in zip(cuts, [*cuts[1:], len(text)]):
                own = items.setdefault(int(text[a]), set())
                for w in np.unique(window[a:b]):
                    own.update(table.items[table.first_item[w] : table.first_item[w + 1]].tolist())
        return np.cumsum(edge[:-1]) > 0, {t: [self.names[i] for i in sorted(own)] for t, own in items.items()}


def _runs(covered: np.ndarray, first: int, end: int) -> list[dict]:
    """The runs of covered words of one text, as places in it."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered[first:end].view(np.int8), [0]])))
    return [{"first": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
_FOUND = "n_words bigint, n_hit bigint, spans array<struct<first: int, end: int>>, items array<string>"


def _searched(rows: DataFrame, patterns: Patterns, keep_text: bool) -> DataFrame:
    """Each row with the occurrences of these patterns added to those it has."""
    held = rows.sparkSession.sparkContext.broadcast(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n_words, n_hit, spans, items = [], [], batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for row, part in texts(batch.column("_text"), BREAKS):
                covered, found = held.value.mark(part)
                for i, (a, b) in enumerate(zip(part.first[:-1].tolist(), part.first[1:].tolist())):
                    for span in spans[row + i]:
                        covered[a + span["first"] : a + span["end"]] = True
                    if i in found or spans[row + i]:
                        spans[row + i] = _runs(covered, a, b)
                        items[row + i] = sorted({*items[row + i], *found.get(i, ())})
                    n_words.append(b - a)
                    n_hit.append(sum(s["end"] - s["first"] for s in spans[row + i]))
            own = [batch.column(name) for name in given]
            made = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*own, *made], [*given, "n_words", "n_hit", "spans", "items"])

    given = ["_key", "_text"] if keep_text else ["_key"]
    shape = ", ".join(f"{name} {kind}" for name, kind in rows.select(given).dtypes)
    return rows.mapInArrow(run, f"{shape}, {_FOUND}")


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, shard_bytes: int = SHARD_BYTES, key: str = "doc_id"
) -> DataFrame:
    """A row per document: key, n_words, n_hit, spans and items.

    spans: runs of hit words, from `first` up to before `end`, counted from 0; items: ids, as
    strings in code-point order, of the items of which a window occurs. The rows are written
    to the shared folder where there is more than one shard of items.
    """
    spark = docs.sparkSession
    parts = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    total = parts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = max(1, -(-total // shard_bytes))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards))
    kind = dict(docs.dtypes)[key]
    none = "cast(array() as array<struct<first: int, end: int>>) as spans", "cast(array() as array<string>) as items"
    rows = docs.select(F.col(key).alias("_key"), F.col("text").cast("string").alias("_text")).selectExpr("*", *none)

    def patterns(number: int) -> Patterns:
        got = parts.filter(shard == number).orderBy("item_id", "text").collect()
        return Patterns([r["item_id"] for r in got], [r["text"] for r in got], size)

    if n_shards == 1:
        return _searched(rows, patterns(0), keep_text=False).withColumnRenamed("_key", key)
    with Scratch(spark) as scratch:
        for number in range(n_shards - 1):
            rows = scratch.keep(_searched(rows, patterns(number), keep_text=True)).drop("n_words", "n_hit")
        found = _searched(rows, patterns(n_shards - 1), keep_text=False)
        return stored(found.select(F.col("_key").cast(kind).alias(key), "n_words", "n_hit", "spans", "items"))


def digests(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each document."""
    return contamination(docs, benchmark, size, shard_bytes).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
