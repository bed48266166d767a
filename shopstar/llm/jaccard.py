"""Near-duplicate components by a grouped prefix join on word shingles.

A text's set holds the distinct runs of `size` words, A-Z as a-z; a shorter text's is its
whole sequence, and one without words has none and is linked with nothing. Two sets are
linked if their Jaccard similarity is at least `percent` hundredths.

Texts with equal sets are one member. Two sets that similar share an element among the first
n - ceil(n * percent / 100) + 1 in any common order; the order here puts elements rare in the
corpus first. How rare is read from a fixed-size count over all texts, which any error leaves
a common order. Members with the same prefix and size are one group, which is listed under
each element of the prefix once. Groups that share an element, and pass the size and position
filters, which ask for no more than prefix and size, are candidate pairs. These are expanded
to pairs of members. Parities, a bit or two for each element, rule most of the dissimilar out
without the sets, and the rest is verified on whole sets.

Only components are wanted, so no list emits all its pairs: its first entries are compared
with the rest, then the next few, in rounds that grow eightfold. Members of a group differ and
need not be similar. So a pair of groups is passed over only if all members of both are in one
component, and a list is done with when all members of all its entries are, or every pair has
been compared. The members of a group are a list of their own, and a group of more than about
MEMBERS is several entries in the other lists, so that no product grows with it.

Elements are 64-bit hashes. Null texts have no words. Rows of the same id count as one
document; rows with a null id are linked with nothing and have a null component. Other
columns are ignored, and no row gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstar.llm.links import components, picked
from shopstar.llm.sums import totals
from shopstar.llm.tidy import tidy
from shopstar.llm.words import texts, windows
from shopstar.operators.sequence import number_in_group
from shopstar.sources.scratch import Scratch, stored

SIZE = 5
PERCENT = 75
CELLS = 1 << 20
ROUND_GROWTH = 8
MEMBERS = 8
# A bit set of at most 8 MB is broadcast.
MOST_BITS = 26
# Ids that stand in for missing and repeated ones begin here.
SUBSTITUTES = 1 << 62


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    for _, part in texts(column):
        words = part.hashes(fold=True)
        runs, begin = windows(words, part.first, size)
        counts = np.diff(part.first)
        few = np.flatnonzero((counts > 0) & (counts < size))
        short = {}
        for length in range(1, size):
            # One run of the text's own length is the whole of it.
            own = few[counts[few] == length]
            if len(own):
                hashes, at = windows(words, part.first, length)
                short |= {int(i): hashes[at[i] : at[i] + 1] for i in own}
        for i in range(len(part)):
            yield short[i] if i in short else np.unique(runs[begin[i] : begin[i + 1]])


def _frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """Per cell of element hashes, the logarithm of its count over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        sums = np.zeros(CELLS, np.int64)
        for batch in batches:
            held = [found & np.uint64(CELLS - 1) for found in shingle_sets(batch.column(0), size)]
            if held:
                sums += np.bincount(np.concatenate(held).astype(np.int64), minlength=CELLS)
        return sums

    whole = totals(docs, count, np.int32)
    whole = np.zeros(CELLS) if whole is None else whole
    return np.ceil(64 * np.log2(whole + 1)).astype(np.uint16)


def _parities(found: np.ndarray) -> bytes:
    """A bit for each of at least len(found) places: whether an odd number falls there."""
    places = 1 << max(6, (len(found) - 1).bit_length())
    counts = np.bincount((found >> np.uint64(24) & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def _unlike(x: np.ndarray, y: np.ndarray) -> int:
    """At least how many elements are in one set only, by the sets' parities."""
    if len(x) != len(y):
        x, y = (x, y) if len(x) < len(y) else (y, x)
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """id, n, digest of the set, parities, prefix, and digest of prefix and size, of every text."""
    rank = docs.sparkSession.sparkContext.broadcast(_frequencies(docs.select("text"), size))
    names = ["id", "n", "whole", "parities", "prefix", "alike"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, whole, parities, prefix, alike = [], [], [], [], []
            for found in shingle_sets(batch.column(1), size):
                order = np.argsort(rank.value[found & np.uint64(CELLS - 1)], kind="stable")
                kept = found[order[: len(found) - -(-len(found) * percent // 100) + 1]]
                n.append(len(found))
                whole.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                parities.append(_parities(found) if len(found) else None)
                prefix.append(kept.view(np.int64))
                alike.append(hashlib.blake2b(kept.tobytes(), digest_size=16, salt=len(found).to_bytes(8)).digest() if len(found) else None)
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            columns = (n, whole, parities, prefix, alike)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(columns, kinds))], names)

    shape = "id bigint, n bigint, whole binary, parities binary, prefix array<bigint>, alike binary"
    return docs.select("id", "text").mapInArrow(tidy(run), shape)


def _able(n1: Column, at1: Column, n2: Column, at2: Column, percent: int) -> Column:
    """Whether sets of these sizes, first meeting at these places, can be similar enough."""
    smaller, larger = F.least(n1, n2), F.greatest(n1, n2)
    most = F.least(n1 - at1, n2 - at2)
    return (smaller * 100 >= larger * percent) & (most * (100 + percent) >= (n1 + n2) * percent)


def _paired(pairs: DataFrame, held: DataFrame, *columns: str) -> DataFrame:
    """a, b and, for either, the columns held under its id."""
    for side in ("a", "b"):
        own = held.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])


def _plausible(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parities leave room for enough common elements.

    What two sets do not share shows in odd places, so the count of those that differ is
    never above the number of such elements: no similar pair is lost.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (batch.column(2).to_numpy() + batch.column(3).to_numpy()).tolist()
            keep = []
            for n, x, y in zip(both, batch.column(4), batch.column(5)):
                apart = _unlike(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8))
                keep.append((n - apart) * (100 + percent) >= 2 * n * percent)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return _paired(pairs, found, "n", "parities").mapInArrow(check, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    ids = scratch.keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [x.tobytes() for x in shingle_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "held"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                common = int((x[at] == y).sum())
                keep.append(common * (100 + percent) >= (len(x) + len(y)) * percent)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sets = scratch.keep(picked(docs.select("id", "text"), "id", ids).mapInArrow(tidy(read), "id bigint, held binary"))
    links = scratch.keep(_paired(pairs, sets, "held").mapInArrow(tidy(check), "a bigint, b bigint"))
    scratch.drop(sets)
    return links


def _grouped(heads: DataFrame, scratch: Scratch) -> DataFrame:
    """g, m, p: members of groups that have several; g is the smallest of an entry's members
    and p tells groups apart. A group of more than MEMBERS is parted by a hash."""
    several = heads.groupBy("alike").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    entry = F.pmod(F.xxhash64("id"), F.ceil(F.col("c") / MEMBERS))
    rows = heads.join(several, "alike").select("alike", F.col("id").alias("m"), "n", entry.alias("entry"))
    first = F.min("m").over(Window.partitionBy("alike", "entry"))
    return scratch.keep(rows.select(first.alias("g"), "m", "n", F.xxhash64("alike").alias("p")))


def _seen_twice(prefixes: DataFrame, scratch: Scratch) -> np.ndarray:
    """A bit for each value of an element's leading bits: set if any such element is in two
    prefixes. A set bit proves nothing; an element whose bit is not set is in one prefix."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, counts = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(counts, pa.int64())], ["token", "n"])

    # Counted by batch before the shuffle, so that what all texts share is a row per batch.
    counted = prefixes.select("prefix").mapInArrow(count, "token bigint, n bigint")
    often = counted.repartition("token").groupBy("token").agg(F.sum("n").alias("n")).filter("n > 1").select("token")
    often = scratch.keep(often)
    bits = min(max(20, (16 * often.count()).bit_length()), MOST_BITS)
    place = F.shiftrightunsigned("token", 64 - bits)
    words = often.select(place.alias("p")).selectExpr("cast(shiftright(p, 6) as int) as word", "shiftleft(1L, cast(p & 63 as int)) as bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _lists(found: DataFrame, classes: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """Entries of every list that has at least two: inner, token, g, p, where, rank and last.

    Under an element (token) are the groups with it in their prefix, `where` being their size
    and its place; inner lists have the members of one group.
    """
    hidden = scratch.keep(members.filter("m != g").select("m"))
    heads = picked(picked(found.filter("n > 0").select("id", "n", "prefix"), "id", classes), "id", hidden, without=True)
    held = found.sparkSession.sparkContext.broadcast(_seen_twice(heads, scratch))

    def list_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        shift = np.uint64(64 - (len(bits).bit_length() + 5))
        for batch in batches:
            prefixes = batch.column(2)
            counts = np.diff(prefixes.offsets.to_numpy())
            tokens = prefixes.flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), counts)
            at = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
            place = tokens.view(np.uint64) >> shift
            kept = np.flatnonzero(bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1))
            where = (batch.column(1).to_numpy()[owner[kept]] << 32) + at[kept]
            arrays = [tokens[kept], batch.column(0).to_numpy()[owner[kept]], where]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["token", "g", "where"])

    entries = scratch.keep(heads.mapInArrow(tidy(list_up), "token bigint, g bigint, where bigint"))
    firsts = members.filter("m = g").select("g", "p")
    outer = entries.join(firsts, "g", "left").select(F.lit(False).alias("inner"), "token", "g", "p", "where")
    own = members.select(F.lit(True).alias("inner"), F.col("p").alias("token"), F.col("m").alias("g"), F.lit(None).cast("bigint").alias("p"), F.shiftleft("n", 32).alias("where"))
    numbered = [number_in_group(rows, "token", F.col("g"), "g", "rank", "last", scratch.keep) for rows in (outer, own)]
    return scratch.keep(numbered[0].unionByName(numbered[1]).filter("last > 1"))


def _located(lists: DataFrame, members: DataFrame, joined: DataFrame) -> DataFrame:
    """The entries with the smallest and largest component of their members."""
    component = F.coalesce("component", "m")
    of_groups = members.join(joined, F.col("m") == F.col("node"), "left").groupBy("g")
    of_groups = of_groups.agg(F.min(component).alias("low"), F.max(component).alias("high"))
    rows = lists.drop("x", "y").join(joined.withColumnRenamed("node", "g"), "g", "left").join(of_groups, "g", "left")
    own = F.coalesce("component", "g")
    either = lambda end: F.when(F.col("inner"), own).otherwise(F.coalesce(end, own))
    return rows.withColumns({"x": either("low"), "y": either("high")}).drop("component", "low", "high")


def _expanded(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of members, smaller one first, for pairs of entries."""
    for side in ("a", "b"):
        own = members.select(F.col("g").alias(side), F.col("m").alias(f"m_{side}"), F.lit(False).alias("inner"))
        pairs = pairs.join(own, [side, "inner"], "left").withColumn(side, F.coalesce(f"m_{side}", side)).drop(f"m_{side}")
    return pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(found: DataFrame, docs: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """node and component of every linked member, by its smallest id."""
    classes = found.filter("n > 0 and id is not null").groupBy("whole").agg(F.min("id").alias("id"))
    classes = scratch.keep(classes.select("id").distinct())
    members = _grouped(picked(found.filter("n > 0").select("id", "n", "alike"), "id", classes), scratch)
    lists = _lists(found, classes, members, scratch)
    sized = found.filter("n > 0").select("id", "n", "parities")
    n, place = lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)
    able = _able(n("a_where"), place("a_where"), n("where"), place("where"), percent)
    # Members of one group are compared in its own list.
    other = F.coalesce(F.col("p") != F.col("a_p"), F.lit(True))

    joined = None
    low, high = 1, 2
    while True:
        if joined is None:
            own, apart = lists, F.lit(True)
        else:
            own = scratch.keep(_located(lists, members, joined))
            scratch.drop(lists)
            state = own.groupBy("inner", "token").agg(F.min("x").alias("least"), F.max("y").alias("most"), F.max("last").alias("n"))
            going = state.filter((F.col("least") != F.col("most")) & (F.col("n") > low)).select("inner", "token")
            # A list that is one component, or compared throughout, is done with.
            lists = scratch.keep(own.join(going, ["inner", "token"], "left_semi"))
            scratch.drop(own)
            own = lists
            if own.isEmpty():
                return joined
            apart = (F.least("x", "a_x") != F.greatest("y", "a_y"))
        first = own.filter((F.col("rank") >= low) & (F.col("rank") < high)).select(
            "inner", "token", *[F.col(c).alias("a" if c == "g" else f"a_{c}") for c in own.columns if c not in ("inner", "token", "last")]
        )
        pairs = own.join(first, ["inner", "token"]).filter((F.col("rank") > F.col("a_rank")) & apart & able & other)
        pairs = _expanded(pairs.select("inner", "a", F.col("g").alias("b")).distinct(), members)
        pairs = scratch.keep(_plausible(pairs, sized, percent))
        links = _verified(pairs, docs, size, percent, scratch)
        if joined is not None:
            links = links.union(joined.select(F.col("node").alias("a"), F.col("component").alias("b")))
        joined = components(links, scratch)
        low, high = high, high * ROUND_GROWTH


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Key, n_shingles and component_id (the smallest key reachable) of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    with Scratch(spark) as scratch:
        found = scratch.keep(_prefixes(rows, size, percent))
        joined = _links(found, rows, size, percent, scratch)
        firsts = found.filter("n > 0").groupBy("whole").agg(F.min("id").alias("node"))
        named = firsts.join(joined, "node", "left").select("whole", F.coalesce("component", "node").alias("component"))
        own = found.select("id", "n", "whole").join(named, "whole", "left")
        component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
        return stored(own.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")))


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest key.

    Rows without a key, and rows of a key that occurs more than once, are judged by their text
    all the same, each as a document of its own, and stay only if no row with a key of its own
    is in their component; of rows alike in key and text one stays. Rows without words are
    linked with nothing: all stay, unless they are alike in their key.
    """
    words = F.coalesce(F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    many = stored(docs.groupBy(key).count().filter("count > 1").select(key).filter(F.col(key).isNotNull()))
    marked = docs.join(many.select(F.col(key).alias("__many")), F.col(key) == F.col("__many"), "left")
    top = docs.agg(F.max(F.col(key).cast("bigint"))).first()[0]
    if top is not None and top >= SUBSTITUTES:
        raise ValueError(f"keys of {SUBSTITUTES} and more are taken")
    hashed = F.xxhash64(key, F.col(text).cast("string")).bitwiseAND((1 << 61) - 1) + SUBSTITUTES
    own = F.when(F.col(key).isNotNull() & F.col("__many").isNull(), F.col(key).cast("bigint"))
    marked = marked.withColumn("__id", own.when(F.col(key).isNotNull() | words, hashed)).drop("__many")
    found = near_duplicates(marked, "__id", text, size, percent)
    gone = stored(found.filter("__id != component_id").select("__id").distinct())
    twice = stored(found.filter("__id is not null").groupBy("__id").count().filter("count > 1").select("__id"))
    left = picked(marked, "__id", gone, without=True)
    once = picked(left, "__id", twice).dropDuplicates(["__id"])
    return picked(left, "__id", twice, without=True).union(once).select(*docs.columns)
