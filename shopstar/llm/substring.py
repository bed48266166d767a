"""Removal of word passages that occur elsewhere, by suffix automata over reference shards.

A window is `length` consecutive words of one text. Every word that lies in a window whose
word sequence also starts anywhere else, in the same text or another, is removed; windows
are judged on the input.

A window's anchor is the run of GRAM words in it with the smallest hash, so that equal
windows have equal anchors. The windows of a text that share an anchor make a region of at
most 2 * length - GRAM words. Regions whose anchor occurs once cannot repeat. The others go
to the reference shard of their anchor, identical regions once with their number of copies.
A shard's suffix automaton holds the regions and counts the places where each of its states
ends; regions stream through it for their matching statistics, and a position whose last
`length` words end in two places or more closes a repeated window. The reference grows with
the corpus, so that its shards cannot be broadcast to every text: instead the anchor sends
each region to the one shard that can hold its equals.

An anchor with more than CROWD different regions would not fit one shard. Its regions are cut
again by the smallest run of twice as many words, and dealt out to automata by that; and so
on, up to runs as long as a window, of which one shard has only equal ones.

Words are compared by 64-bit hashes. A row is known by two 64-bit hashes of its text and id.

Null texts have no words. Repeated rows are places of their own, also under one id or none;
ids may repeat, with the same text or others. Texts of fewer than `length` words lose nothing.
An empty table gives an empty one. Other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.links import picked
from shopstar.llm.tidy import tidy
from shopstar.llm.words import spans_hash, texts
from shopstar.sources.scratch import Scratch, stored

LENGTH = 35
GRAM = 9
CROWD = 5000
SHARD_REGIONS = 1000


class Automaton:
    """Suffix automaton of several word sequences that counts where its states end."""

    def __init__(self):
        self.steps: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        self.places = [0]

    def _state(self, size: int, steps: dict[int, int], link: int) -> int:
        self.steps.append(steps)
        self.size.append(size)
        self.link.append(link)
        self.places.append(0)
        return len(self.size) - 1

    def _split(self, before: int, word: int, target: int) -> int:
        """The state for the longest sequence that reaches target through this step."""
        steps, size, link = self.steps, self.size, self.link
        if size[target] == size[before] + 1:
            return target
        copy = self._state(size[before] + 1, steps[target].copy(), link[target])
        link[target] = copy
        while before >= 0 and steps[before].get(word) == target:
            steps[before][word] = copy
            before = link[before]
        return copy

    def add(self, words: list[int], copies: int) -> None:
        steps, link, size, places = self.steps, self.link, self.size, self.places
        last = 0
        for word in words:
            target = steps[last].get(word)
            if target is not None:
                last = self._split(last, word, target)
            else:
                new = self._state(size[last] + 1, {}, 0)
                at = last
                while at >= 0 and (target := steps[at].get(word)) is None:
                    steps[at][word] = new
                    at = link[at]
                if at >= 0:
                    link[new] = self._split(at, word, target)
                last = new
            places[last] += copies

    def close(self) -> None:
        """Hand every state's places on to the shorter sequences that end there too."""
        places, link = self.places, self.link
        for state in np.argsort(self.size, kind="stable")[:0:-1].tolist():
            places[link[state]] += places[state]

    def repeats(self, words: list[int], length: int) -> int:
        """Bit i is set if the window that starts at word i ends in two places or more."""
        steps, link, size, places = self.steps, self.link, self.size, self.places
        state, found = 0, 0
        for at, word in enumerate(words):
            state = steps[state][word]
            # Forget words beyond the window: the state then stands for its last words only.
            while size[link[state]] >= length:
                state = link[state]
            if at >= length - 1 and places[state] > 1:
                found |= 1 << (at - length + 1)
        return found


def _regions(words: np.ndarray, first: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, text, first word and number of windows of each region."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    if not counts.sum():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    begin = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(begin[-1]) + (first[:-1] - begin[:-1])[owner]
    at = np.arange(len(words) - gram + 1)
    grams = spans_hash(words, at, at + gram)
    # Leftmost smallest of so many runs from each place on, by doubling.
    least, place, reach, wanted = grams, at, 1, length - gram + 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        left = least[: len(least) - step] <= least[step:]
        place = np.where(left, place[: len(place) - step], place[step:])
        least = np.where(left, least[: len(least) - step], least[step:])
        reach += step
    anchor = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    number = np.diff(np.concatenate([head, [len(start)]]))
    content = spans_hash(words, start[head], start[head] + number + length - 1)
    return grams[anchor[head]].view(np.int64), content.view(np.int64), owner[head], start[head] - first[owner[head]], number


def _placed(docs: DataFrame, length: int) -> DataFrame:
    """anchor, region (content hash), id, h, and place (first word and number of windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, part in texts(batch.column(2)):
                anchor, region, owner, start, number = _regions(part.hashes(), part.first, length)
                columns = [anchor, region, ids[row + owner], marks[row + owner], start << 16 | number]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "region", "id", "h", "place"])

    return docs.mapInArrow(tidy(run), "anchor bigint, region bigint, id bigint, h bigint, place bigint")


def _contents(places: DataFrame, docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """anchor, region, copies and the words (as hashes) of each listed region."""
    ids = scratch.keep(places.select("id").distinct())
    wanted = F.collect_list(F.struct("anchor", "region", "copies", "place")).alias("wanted")
    rows = picked(docs, "id", ids).join(places.groupBy("id", "h").agg(wanted), ["id", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).to_pylist()
            for row, part in texts(batch.column(0)):
                words = part.hashes()
                out: list[list] = [[], [], [], []]
                for i in range(len(part)):
                    for one in lists[row + i]:
                        begin = part.first[i] + (one["place"] >> 16)
                        end = begin + (one["place"] & 0xFFFF) + length - 1
                        for column, value in zip(out, (one["anchor"], one["region"], one["copies"], words[begin:end].tobytes())):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["anchor", "region", "copies", "words"])

    return rows.select("text", "wanted").mapInArrow(tidy(run), "anchor bigint, region bigint, copies int, words binary")


def _judged(contents: DataFrame, shards: int, length: int) -> DataFrame:
    """anchor, region and found (bits of repeated windows) by the automaton of its shard."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["anchor", "region"])
        parts = [np.frombuffer(x, np.uint64) for x in group["words"]]
        # Small numbers for the words of this shard.
        _, small = np.unique(np.concatenate(parts), return_inverse=True)
        cuts = np.cumsum([len(x) for x in parts])[:-1]
        lists = [x.tolist() for x in np.split(small, cuts)]
        held = Automaton()
        for words, copies in zip(lists, group["copies"]):
            held.add(words, int(copies))
        held.close()
        found = [held.repeats(words, length) for words in lists]
        return pd.DataFrame({"anchor": group["anchor"], "region": group["region"], "found": found})

    # A task builds the automata of its shards one after the other.
    dealt = contents.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, "anchor bigint, region bigint, found bigint")


def _cut(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """The regions cut by their windows' smallest runs of `gram` words.

    Of each piece: the region it is of, its first window there, and what a region has.
    """
    names = ["of_anchor", "of_region", "at", "anchor", "region", "copies", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for anchor, region, copies, data in zip(*(c.to_pylist() for c in batch.columns)):
                words = np.frombuffer(data, np.uint64)
                pieces = _regions(words, np.array([0, len(words)]), length, gram)
                for own, content, _, start, number in zip(*(x.tolist() for x in pieces)):
                    piece = words[start : start + number + length - 1].tobytes()
                    for column, value in zip(out, (anchor, region, start, own, content, copies, piece)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    shape = "of_anchor bigint, of_region bigint, at int, anchor bigint, region bigint, copies int, words binary"
    rows = contents.select("anchor", "region", "copies", "words").dropDuplicates(["anchor", "region"])
    return rows.mapInArrow(run, shape)


def _repeated(contents: DataFrame, length: int, scratch: Scratch, gram: int = GRAM) -> DataFrame:
    """anchor, region and found of each region; contents are stored."""
    crowded = scratch.keep(contents.groupBy("anchor").count().filter(F.col("count") > CROWD).select("anchor"))
    shards = max(1, -(-contents.count() // SHARD_REGIONS))
    found = _judged(picked(contents, "anchor", crowded, without=True), shards, length)
    if gram == length or crowded.isEmpty():
        return found
    finer = min(2 * gram, length)
    pieces = scratch.keep(_cut(picked(contents, "anchor", crowded), length, finer))
    once = pieces.groupBy("anchor", "region").agg(
        F.least(F.sum("copies"), F.lit(2)).cast("int").alias("copies"), F.first("words").alias("words")
    )
    below = _repeated(scratch.keep(once), length, scratch, finer)
    bits = F.bit_or(F.expr("shiftleft(found, at)")).alias("found")
    back = pieces.drop("copies", "words").join(below, ["anchor", "region"]).groupBy("of_anchor", "of_region").agg(bits)
    return found.union(back)


def _spans(docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """id, h and spans (first word and bits of repeated windows) of each text that has any."""
    placed = scratch.keep(_placed(docs, length))
    # An anchor is counted on the map side, and met by a join that splits hot ones, as it can
    # where both sides come straight from their shuffles; only regions with an anchor that
    # occurs twice are gathered by content.
    often = scratch.keep(placed.groupBy("anchor").count().filter("count > 1").select("anchor"))
    shared = scratch.keep(placed.join(often, "anchor", "left_semi"))
    scratch.drop(placed)
    copies = F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("copies")
    # What first() gives is one row's, any of them.
    heads = scratch.keep(
        shared.groupBy("anchor", "region").agg(copies, *[F.first(c).alias(c) for c in ("id", "h", "place")])
    )
    contents = scratch.keep(_contents(heads, docs, length, scratch))
    found = scratch.keep(_repeated(contents, length, scratch).filter("found != 0"))
    scratch.drop(contents)
    places = shared.join(found, ["anchor", "region"])
    span = F.struct(F.shiftright("place", 16).alias("start"), "found")
    return scratch.keep(places.groupBy("id", "h").agg(F.collect_set(span).alias("spans")))


def _kept(words: list[bytes], spans: list[dict], length: int) -> list[bytes]:
    edges = np.zeros(len(words) + 1, np.int64)
    for span in spans:
        starts = span["start"] + np.flatnonzero(np.array([span["found"] >> i & 1 for i in range(length)]))
        edges[starts] += 1
        np.add.at(edges, starts + length, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return [w for w, gone in zip(words, covered.tolist()) if not gone]


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """With __id and __h: 128 bits that tell rows of different ids or texts apart."""
    value = F.col(text).cast("string")
    return docs.withColumns({"__id": F.xxhash64(F.lit("row"), F.col(key), value), "__h": F.xxhash64(value)})


def repeated_spans(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """__id, __h (hashes of key and text) and __spans of each text with a repeat."""
    if not GRAM <= length < GRAM + 62:
        raise ValueError(f"windows of {GRAM} to {GRAM + 61} words can be handled")
    rows = _marked(docs, key, text).select(F.col("__id").alias("id"), F.col("__h").alias("h"), F.col(text).cast("string").alias("text"))
    return _spans(rows, length, scratch).withColumnsRenamed({"id": "__id", "h": "__h", "spans": "__spans"})


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Key, n_words, n_removed and kept_sha256 (words kept, joined by one space) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            spans = batch.column(2).to_pylist() if batch.num_columns > 2 else None
            for i, value in enumerate(batch.column(1).to_pylist()):
                words = (value or "").encode().split()
                kept = _kept(words, spans[i], length) if spans else words
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.string())
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["_key", "n_words", "n_removed", "kept_sha256"])

    shape = f"_key {dict(docs.dtypes)[key]}, n_words bigint, n_removed bigint, kept_sha256 string"
    columns = [F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")]
    with Scratch(docs.sparkSession) as scratch:
        spans = repeated_spans(docs, scratch, key, text, length)
        ids = scratch.keep(spans.select("__id").distinct())
        rows = _marked(docs, key, text)
        touched = picked(rows, "__id", ids).join(spans, ["__id", "__h"], "left")
        touched = touched.select(*columns, F.coalesce("__spans", F.array()).alias("spans")).mapInArrow(tidy(run), shape)
        rest = picked(rows, "__id", ids, without=True).select(*columns).mapInArrow(tidy(run), shape)
        return stored(touched.union(rest).withColumnRenamed("_key", key))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The rows with repeated words gone from the text; other texts stay as they are.

    Where words are removed, those kept are joined by one space, and n_chars follows.
    """
    shape = docs.schema
    at = docs.columns.index(text)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for value, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                kept.append(b" ".join(_kept(value.encode().split(), spans, length)).decode() if spans else value)
            arrays = list(batch.columns[:-1])
            arrays[at] = pa.array(kept, arrays[at].type)
            if counted is not None:
                lengths = [len(k) if s else n for k, s, n in zip(kept, batch.column(batch.num_columns - 1).to_pylist(), arrays[counted].to_pylist())]
                arrays[counted] = pa.array(lengths, arrays[counted].type)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:-1])

    with Scratch(docs.sparkSession) as scratch:
        spans = stored(repeated_spans(docs, scratch, key, text, length))
    ids = stored(spans.select("__id").distinct())
    rows = _marked(docs, key, text)
    touched = picked(rows, "__id", ids).join(spans, ["__id", "__h"], "left").select(*docs.columns, "__spans")
    rest = picked(rows, "__id", ids, without=True).select(*docs.columns)
    return touched.mapInArrow(tidy(run), shape).union(rest)
