"""Spelling variants: frequency-vector trie over the words of all documents.

A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. To plant known
variants, one code point is left out of each occurrence whose text `<id>:<word>` has a CRC-32
that 31 divides. Words of at least `least_length` code points that occur at least twice are
grouped: two are near if they differ by exactly one inserted, deleted or replaced code point;
a word's form is its near word of largest count (ties: smallest in code-point order), if that
is at least ten times its own; its root is where its forms lead.

Near words are found in tries. The letters are dealt out to groups of about equal use; a word
is the vector of its counts per group, and a level of the trie branches by one count. One edit
adds one letter, takes one away, or does both, so a search goes down with a budget of one count
too many and one too few, depth first, a bounded number of paths at a time. What is left in a
leaf, or under a branch of few words, is verified letter by letter.

A trie holds the words that begin with the same counts, as many counts as bring it below
`trie_words` words; a word is sent to every trie that its budget reaches. Words alike in all
counts beyond that are dealt out over several tries, and words sent to a trie in blocks of that
size, so no task holds more, however words cluster.

Null and empty texts have no words. A null id counts as the empty text; repeated rows count as
often as they occur. Empty tables give no row. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.words import FOLDED, Texts, spans_hash, texts
from shopstar.sources.scratch import Scratch, stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_TIMES = 10
DIVISOR = 31
# Words that a task counts before it passes them on.
HELD_WORDS = 1 << 18
# The remainders of CRC-32 (polynomial EDB88320, reflected) by byte.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
# U+00C0 to U+00FF is this byte and one more.
_LATIN = 0xC3


def runs(part: Texts) -> Texts:
    """The same texts, lower case, with everything else than the letters as breaks."""
    data = part.data
    latin = data == _LATIN
    letter = _ASCII_LETTER[data] | latin
    letter[1:] |= latin[:-1]
    return Texts(np.where(letter, _LOWER[data], 32).astype(np.uint8), part.bounds)


def checksums(part: Texts, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each word after a text's own beginning, whose CRC-32 is given."""
    sizes = part.ends - part.starts
    order = np.argsort(-sizes, kind="stable")
    live = np.searchsorted(-sizes[order], -np.arange(1, sizes.max(initial=0) + 1), side="right")
    crc = np.repeat(before, np.diff(part.first))[order] ^ np.uint32(0xFFFFFFFF)
    start = part.starts[order]
    for i, n in enumerate(live.tolist()):
        crc[:n] = _CRC[(crc[:n] ^ part.data[start[:n] + i]) & 0xFF] ^ crc[:n] >> 8
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


class Counts:
    """Words and how often they were met, up to a bounded number of them."""

    def __init__(self):
        self.words: dict[int, list] = {}
        self.bytes = 0

    def add(self, key: int, count: int, word: bytes) -> None:
        if key in self.words:
            self.words[key][1] += count
        else:
            self.words[key] = [word, count]
            self.bytes += len(word)

    def batch(self) -> pa.RecordBatch:
        words = [w.decode() for w, _ in self.words.values()]
        counts = [n for _, n in self.words.values()]
        self.__init__()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])


def _points(part: Texts) -> np.ndarray:
    """Code points of each word."""
    lead = np.append(0, np.cumsum(part.data & 0xC0 != 0x80))
    return lead[part.ends] - lead[part.starts]


def vocabulary(docs: DataFrame, key: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, divisor: int = DIVISOR) -> DataFrame:
    """word and n, its number of occurrences in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counts()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, raw in texts(batch.column(1)):
                part = runs(raw)
                heads = [zlib.crc32(f"{i}:".encode()) for i in ids[row : row + len(part)]]
                drawn = checksums(part, np.array(heads, np.uint32))
                points = _points(part)
                cut = drawn % divisor == 0
                for at in np.flatnonzero(cut & (points > least_length)):
                    word = part.word(at).decode()
                    place = int(drawn[at]) % len(word)
                    word = (word[:place] + word[place + 1 :]).encode()
                    whole = np.frombuffer(word, np.uint8)
                    held.add(int(spans_hash(FOLDED[whole], np.array([0]), np.array([len(word)]))[0]), 1, word)
                kept = np.flatnonzero(~cut & (points >= least_length))
                hashes = spans_hash(FOLDED[part.data], part.starts[kept], part.ends[kept])
                own, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                for h, at, n in zip(own.tolist(), kept[first].tolist(), counts.tolist()):
                    held.add(h, n, part.word(at))
                if len(held.words) >= HELD_WORDS or held.bytes >= HELD_WORDS * 64:
                    yield held.batch()
        yield held.batch()

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("text").cast("string"))
    found = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= least_count)


# Letter groups, one for each level of a trie, and how many counts a level tells apart: counts
# go round, so that one letter more or less is one step in any case.
GROUPS = 16
TURN = 8
# The top of the trie that the driver cuts: at most TURN ** TOP cells, 32,768.
TOP = 5
TRIE_WORDS = 1 << 16
BLOCK_WORDS = 1 << 17
# A branch of so few words is not divided further.
FEW = 8
PATHS = 1 << 17
# Longer words are compared one pair at a time.
WIDE = 40


class Words:
    """A column of words as code points (one byte each, since all are below U+0100)."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        whole = column.cast(pa.large_string())
        offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
        data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        lead = data == _LATIN
        second = np.append(False, lead[:-1]) if len(data) else lead
        codes = data + np.where(second, 0x40, 0).astype(np.uint8)
        self.codes = codes[~lead]
        self.bounds = np.append(0, np.cumsum(~lead))[offsets]
        self.sizes = np.diff(self.bounds)
        self.hashes = spans_hash(FOLDED[data], offsets[:-1], offsets[1:])

    def __len__(self) -> int:
        return len(self.sizes)

    def word(self, at: int) -> bytes:
        return self.codes[self.bounds[at] : self.bounds[at + 1]].tobytes()

    def vectors(self, group: np.ndarray) -> np.ndarray:
        """Letters of each group in each word, counted round TURN."""
        n_groups = int(group.max()) + 1
        cell = np.repeat(np.arange(len(self)) * n_groups, self.sizes) + group[self.codes]
        return (np.bincount(cell, minlength=len(self) * n_groups) % TURN).astype(np.uint8).reshape(-1, n_groups)

    def parities(self) -> np.ndarray:
        """A bit for each code point (64 to share), set if it occurs an odd number of times."""
        bit = np.uint64(1) << (self.codes % 64).astype(np.uint64)
        out = np.zeros(len(self), np.uint64)
        full = self.sizes > 0
        out[full] = np.bitwise_xor.reduceat(bit, self.bounds[:-1][full])
        return out

    def table(self) -> np.ndarray:
        """The first WIDE code points of each word, a row each, zeros behind."""
        row = np.repeat(np.arange(len(self)), self.sizes)
        place = np.arange(len(self.codes)) - np.repeat(self.bounds[:-1], self.sizes)
        out = np.zeros((len(self), WIDE), np.uint8)
        out[row[place < WIDE], place[place < WIDE]] = self.codes[place < WIDE]
        return out


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one code point inserted, deleted or replaced makes one of the other."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    same = np.frombuffer(a[: len(b)], np.uint8) == np.frombuffer(b, np.uint8)
    at = len(b) if same.all() else int(np.argmin(same))
    return a[at + 1 :] == b[at + (len(a) == len(b)) :]


def _edits(a: np.ndarray, b: np.ndarray, long_a: np.ndarray, long_b: np.ndarray) -> np.ndarray:
    """one_edit of rows of two tables of words no longer than WIDE."""
    out = np.zeros(len(a), bool)
    level = np.flatnonzero(long_a == long_b)
    out[level] = (a[level] != b[level]).sum(axis=1) == 1
    for rows, more, less, size in ((np.flatnonzero(long_a > long_b), a, b, long_b), (np.flatnonzero(long_a < long_b), b, a, long_a)):
        more, less, size = more[rows], less[rows], size[rows]
        # Up to the letter too many the words agree, and from it on shifted by one.
        apart = more != less
        first = np.where(apart.any(axis=1), apart.argmax(axis=1), size)
        shifted = more[:, 1:] != less[:, :-1]
        shifted[np.arange(WIDE - 1) < np.minimum(first, size)[:, None]] = False
        out[rows] = ~shifted.any(axis=1) & (first <= size)
    return out


class Trie:
    """Words by their vectors; level i branches by the count of group i."""

    def __init__(self, words: Words, group: np.ndarray):
        vectors = words.vectors(group)
        self.group = group
        self.order = np.lexsort(vectors.T[::-1])
        self.sizes, self.odd, self.table = words.sizes[self.order], words.parities()[self.order], words.table()[self.order]
        self.words = words
        vectors = vectors[self.order]
        lo, hi = np.array([0]), np.array([len(words)])
        # Of each level: begin and end of the words under each node, and its child by count.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for level in range(vectors.shape[1] + 1):
            children = np.full((len(lo), TURN), -1, np.int32)
            wide = np.flatnonzero(hi - lo > FEW) if level < vectors.shape[1] else lo[:0]
            self.levels.append((lo, hi, children))
            if not len(wide):
                break
            counts = hi[wide] - lo[wide]
            node = np.repeat(wide, counts)
            row = np.repeat(lo[wide], counts) + np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)
            value = vectors[row, level]
            new = np.append(True, (node[1:] != node[:-1]) | (value[1:] != value[:-1]))
            children[node[new], value[new]] = np.arange(new.sum())
            lo = row[new]
            hi = row[np.append(np.flatnonzero(new)[1:] - 1, len(row) - 1)] + 1

    def near(self, asked: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of an asked word and a word of the trie, by their places, one edit apart."""
        vectors, odd, table = asked.vectors(self.group), asked.parities(), asked.table()
        # A path: the word asked, the node it has come to, and what it has spent (1: surplus, 2: deficit).
        stack = [(0, a, np.zeros(len(a), np.int32), np.zeros(len(a), np.int8)) for a in np.array_split(np.arange(len(asked)), len(asked) // PATHS + 1)]
        while stack:
            level, word, node, spent = stack.pop()
            lo, hi, children = self.levels[level]
            end = (hi - lo)[node] <= FEW if level < len(self.levels) - 1 else np.ones(len(node), bool)
            yield from self._leaves(word[end], lo[node[end]], hi[node[end]], asked, odd, table)
            word, node, spent = word[~end], node[~end], spent[~end]
            if not len(word):
                continue
            count = vectors[word, level]
            steps = []
            for change, cost in ((0, 0), (1, 1), (TURN - 1, 2)):
                can = spent & cost == 0
                child = children[node[can], (count[can] + change) % TURN]
                live = child >= 0
                steps.append((word[can][live], child[live], spent[can][live] | np.int8(cost)))
            paths = [np.concatenate(x) for x in zip(*steps)]
            for part in range(0, len(paths[0]), PATHS):
                stack.append((level + 1, *[x[part : part + PATHS] for x in paths]))

    def _leaves(self, word, lo, hi, asked: Words, odd, table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        reach = np.cumsum(hi - lo)
        while len(word):
            cut = max(1, int(np.searchsorted(reach, reach[0] + 4 * PATHS)))
            counts = (hi - lo)[:cut]
            a = np.repeat(word[:cut], counts)
            b = np.repeat(lo[:cut], counts) + np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
            word, lo, hi, reach = word[cut:], lo[cut:], hi[cut:], reach[cut:]
            live = np.bitwise_count(odd[a] ^ self.odd[b]) <= 2
            a, b = a[live], b[live]
            live = np.abs(asked.sizes[a] - self.sizes[b]) <= 1
            a, b = a[live], b[live]
            short = np.maximum(asked.sizes[a], self.sizes[b]) <= WIDE
            near = np.zeros(len(a), bool)
            near[short] = _edits(table[a[short]], self.table[b[short]], asked.sizes[a[short]], self.sizes[b[short]])
            for i in np.flatnonzero(~short):
                near[i] = one_edit(asked.word(a[i]), self.words.word(self.order[b[i]]))
            yield a[near], self.order[b[near]]


def letter_groups(words: DataFrame, n_groups: int = GROUPS) -> np.ndarray:
    """The group of each code point: the most used go, one by one, to the group used least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(256, np.int64)
        for batch in batches:
            used += np.bincount(Words(batch.column(0)).codes, minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(used)], ["code", "n"])

    found = words.select("word").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    group, load = np.zeros(256, np.int64), np.zeros(n_groups, np.int64)
    for r in sorted(found, key=lambda r: (-r["n"], r["code"])):
        group[r["code"]] = np.argmin(load) if r["n"] else r["code"] % n_groups
        load[group[r["code"]]] += r["n"]
    return group


class Cut:
    """Which tries there are: cells of the top of the trie, divided while they are too large."""

    def __init__(self, cells: dict[tuple[int, ...], int], trie_words: int, block_words: int):
        self.tries: dict[tuple[int, ...], tuple[int, int, int]] = {}
        sums: dict[tuple[int, ...], int] = {}
        for cell, n in cells.items():
            for depth in range(len(cell) + 1):
                sums[cell[:depth]] = sums.get(cell[:depth], 0) + n
        top = max(map(len, cells), default=0)
        pending = [()] if cells else []
        leaves = []
        while pending:
            cell = pending.pop()
            if len(cell) == top or sums[cell] <= trie_words:
                leaves.append(cell)
            else:
                pending += [(*cell, c) for c in range(TURN) if (*cell, c) in sums]
        asked = dict.fromkeys(leaves, 0)
        self.leaves, self._routes = set(leaves), {}
        for cell, n in cells.items():
            for leaf in self.routes(cell):
                asked[leaf] += n
        number = 0
        for leaf in sorted(leaves):
            deals, blocks = -(-sums[leaf] // trie_words), -(-asked[leaf] // block_words)
            self.tries[leaf] = (number, deals, blocks)
            number += deals * blocks

    def routes(self, cell: tuple[int, ...]) -> list[tuple[int, ...]]:
        """The leaves of the cut that a word of this cell can have near words in; its own first."""
        if cell not in self._routes:
            found = []

            def down(prefix: tuple[int, ...], surplus: int, deficit: int) -> None:
                if prefix in self.leaves:
                    found.append(prefix)
                elif len(prefix) < len(cell):
                    count = cell[len(prefix)]
                    down((*prefix, count), surplus, deficit)
                    if surplus:
                        down((*prefix, (count + 1) % TURN), 0, deficit)
                    if deficit:
                        down((*prefix, (count - 1) % TURN), surplus, 0)

            down((), 1, 1)
            self._routes[cell] = found
        return self._routes[cell]


def _cells(words: DataFrame, group: np.ndarray) -> dict[tuple[int, ...], int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own, n = np.unique(_cell_numbers(Words(batch.column(0)), group), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], ["cell", "n"])

    found = words.select("word").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    return {_cell(r["cell"]): r["n"] for r in found}


def _cell_numbers(words: Words, group: np.ndarray) -> np.ndarray:
    top = words.vectors(group)[:, :TOP].astype(np.int64)
    return top @ TURN ** np.arange(top.shape[1])


def _cell(number: int) -> tuple[int, ...]:
    return tuple(number // TURN**i % TURN for i in range(TOP))


# Words that are looked up in the cut at a time.
SENT_WORDS = 1 << 16
_SENT = "trie int, word string, n bigint, own boolean, home boolean"


class Routes:
    """For each cell its tries: number of the first task, deals and blocks, the own one first."""

    def __init__(self, cut: Cut, numbers: np.ndarray):
        lists = [[cut.tries[leaf] for leaf in cut.routes(_cell(int(n)))] for n in numbers]
        self.begin = np.cumsum([0, *map(len, lists)])
        self.first, self.deals, self.blocks = np.array([t for x in lists for t in x], np.int64).reshape(-1, 3).T


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For so many copies of each: which it is a copy of, and the number of the copy."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _sent(words: DataFrame, group: np.ndarray, cut: Cut) -> DataFrame:
    """A row for each task that needs a word: as one of its trie (own), or to ask for.

    home: the one task of those asked whose trie has the word itself.
    """

    def routed(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Words(batch.column(0))
        numbers, cell = np.unique(_cell_numbers(found, group), return_inverse=True)
        routes = Routes(cut, numbers)
        block = (found.hashes >> np.uint64(32)).astype(np.int64)
        deal = (found.hashes & np.uint64(0x7FFFFFFF)).astype(np.int64)
        # The word itself goes to one deal of its own trie, for every block that asks there.
        home = routes.begin[cell]
        dealt = deal % routes.deals[home]
        row, other = _spread(routes.blocks[home])
        own_task = routes.first[home[row]] + dealt[row] * routes.blocks[home[row]] + other
        # It asks in one block of every deal of all its tries.
        at, which = _spread(np.diff(routes.begin)[cell])
        trie = home[at] + which
        copy, number = _spread(routes.deals[trie])
        asker, trie = at[copy], trie[copy]
        ask_task = routes.first[trie] + number * routes.blocks[trie] + block[asker] % routes.blocks[trie]
        is_home = (which[copy] == 0) & (number == dealt[asker])
        rows = pa.array(np.concatenate([row, asker]))
        task = pa.array(np.concatenate([own_task, ask_task]).astype(np.int32))
        own = pa.array(np.concatenate([np.ones(len(row), bool), np.zeros(len(asker), bool)]))
        at_home = pa.array(np.concatenate([np.zeros(len(row), bool), is_home]))
        columns = [task, batch.column(0).take(rows), batch.column(1).take(rows), own, at_home]
        return pa.RecordBatch.from_arrays(columns, ["trie", "word", "n", "own", "home"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= SENT_WORDS:
                yield routed(pa.concat_batches(held))
                held = []
        if sum(map(len, held)):
            yield routed(pa.concat_batches(held))

    return words.select("word", "n").mapInArrow(run, _SENT)


_NEAR = "word string, n bigint, n_near bigint, form_n bigint, form string"


def _searched(sent: DataFrame, group: np.ndarray) -> DataFrame:
    """word, n, and the number and best of the near words that one trie has; a word that the
    trie holds itself is there in any case."""

    def search(table: pa.Table) -> pa.Table:
        own, asks = table.filter(table["own"]), table.filter(pc.invert(table["own"]))
        asked = Words(asks["word"])
        n_near = np.zeros(len(asked), np.int64)
        best, best_n = np.full(len(asked), -1), np.zeros(len(asked), np.int64)
        if len(own):
            # In code-point order, so that of equal counts the first place is the smallest word.
            own = own.sort_by("word")
            counts = own["n"].to_numpy()
            held = len(own) + 1
            for a, b in Trie(Words(own["word"]), group).near(asked):
                n_near += np.bincount(a, minlength=len(asked))
                order = np.lexsort((b, -counts[b], a))
                lead = order[np.append(True, a[order][1:] != a[order][:-1])] if len(order) else order
                a, b = a[lead], b[lead]
                better = (counts[b] > best_n[a]) | (counts[b] == best_n[a]) & (b < np.where(best[a] < 0, held, best[a]))
                best[a[better]], best_n[a[better]] = b[better], counts[b[better]]
        shown = np.flatnonzero((n_near > 0) | asks["home"].to_numpy(zero_copy_only=False))
        none = best[shown] < 0
        names = own["word"].combine_chunks() if len(own) else pa.array([""], pa.string())
        form = names.take(pa.array(np.where(none, 0, best[shown]), mask=none))
        columns = [asks["word"].combine_chunks().take(pa.array(shown)), asks["n"].combine_chunks().take(pa.array(shown))]
        columns += [pa.array(n_near[shown]), pa.array(best_n[shown], mask=none), form]
        return pa.table(columns, ["word", "n", "n_near", "form_n", "form"])

    return sent.groupBy("trie").applyInArrow(search, _NEAR)


def near_words(words: DataFrame, scratch: Scratch, n_groups: int = GROUPS, trie_words: int = TRIE_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, n, n_near, and form_n and form: the near word of largest count, if any.

    words: word (distinct) and n, in a stored table, since it is read several times.
    """
    group = letter_groups(words, n_groups)
    cut = Cut(_cells(words, group), trie_words, block_words)
    found = _searched(_sent(words, group, cut), group)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best")
    found = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    return scratch.keep(found.select("word", "n", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word and root, where its forms lead, of every word with a form.

    A form is FORM_TIMES as frequent as its word, so chains are short; each round makes the
    steps twice as long.
    """
    now = scratch.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = scratch.keep(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    divisor: int = DIVISOR,
    form_times: int = FORM_TIMES,
    **limits: int,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    with Scratch(docs.sparkSession) as scratch:
        words = scratch.keep(vocabulary(docs, key, least_length, least_count, divisor))
        found = near_words(words, scratch, **limits)
        holds = F.col("form_n") >= form_times * F.col("n")
        found = found.withColumns({"form": F.when(holds, F.col("form")), "form_n": F.when(holds, F.col("form_n"))})
        ends = roots(found.filter("form is not null"), scratch)
        rows = found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
        return stored(rows.select("word", "form", "root", "n", "n_near", "form_n"))
