"""Masked pseudo-likelihood of texts under a bidirectional window network.

Every word is predicted from the REACH words on either side of it, itself unseen; a text's
score is the sum of the log-probabilities of its words. The vocabulary comes from counts of
words over the whole corpus, hashed to CELLS cells: the most frequent cells are classes of
their own, the others share RARE classes. A word's probability is that of its class, given
the neighbours, times its share of the class, by the counts (half a word more in each cell).
A class's probability is that of its row in a square of classes times that of its column given
the row, both read off one hidden layer over the embeddings of the neighbours.

Training runs on Spark: each partition trains a copy in numpy on all its texts, and the
copies are averaged by the words they saw, for ROUNDS rounds. In a round every text gives
each ROUNDS-th word, other ones each time, so that in all each word is a target once. What
is gathered grows with the corpus, one network of fixed size from each partition, added up
on the way, in the order of the partitions. The averages depend on how the input is split
into partitions; the same split gives the same scores.

Null texts and texts without words have no word and the score 0; their mean is null. Rows
are scored each by itself, whatever their ids. No row gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.sums import totals
from shopstar.llm.words import texts

SIDE = 32
CLASSES = SIDE * SIDE
RARE = 32
CELLS = 1 << 20
REACH = 2
WIDTH = 12
HIDDEN = 24
ROUNDS = 2
BATCH = 1024
SCORED = 4096
RATE = 0.1
_SHAPES = {
    "embed": (CLASSES + 1, WIDTH),
    "mix": (2 * REACH * WIDTH, HIDDEN),
    "lift": (HIDDEN,),
    "row": (HIDDEN, SIDE),
    "row_bias": (SIDE,),
    "column": (HIDDEN, SIDE),
    "column_bias": (SIDE, SIDE),
}
_OFFSETS = [*range(-REACH, 0), *range(1, REACH + 1)]


def _packed(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[name].ravel() for name in _SHAPES])


def _unpacked(values: np.ndarray) -> dict[str, np.ndarray]:
    net, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        net[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return net


def start(seed: int = 5) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    net = {}
    for name, shape in _SHAPES.items():
        spread = 0.1 if name == "embed" else 0.0 if "bias" in name or name == "lift" else 1 / np.sqrt(shape[0])
        net[name] = (spread * draw.standard_normal(shape)).astype(np.float32)
    return net


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _forward(net, around: np.ndarray, true: np.ndarray):
    seen = net["embed"][around].reshape(len(around), -1)
    hidden = np.tanh(seen @ net["mix"] + net["lift"])
    high, low = true // SIDE, true % SIDE
    rows = _log_softmax(hidden @ net["row"] + net["row_bias"])
    columns = _log_softmax(hidden @ net["column"] + net["column_bias"][high])
    return seen, hidden, high, low, rows, columns


def log_chances(net, around: np.ndarray, true: np.ndarray) -> np.ndarray:
    """Log-probability of each class given its neighbours' classes."""
    *_, high, low, rows, columns = _forward(net, around, true)
    at = np.arange(len(true))
    return rows[at, high] + columns[at, low]


def gradients(net, around: np.ndarray, true: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the mean negative log-probability."""
    seen, hidden, high, low, rows, columns = _forward(net, around, true)
    at, n = np.arange(len(true)), len(true)
    to_rows, to_columns = np.exp(rows), np.exp(columns)
    to_rows[at, high] -= 1
    to_columns[at, low] -= 1
    to_rows /= n
    to_columns /= n
    back = to_rows @ net["row"].T + to_columns @ net["column"].T
    back *= 1 - hidden * hidden
    to_seen = (back @ net["mix"].T).reshape(-1, WIDTH)
    flat = around.ravel()
    embed = np.stack([np.bincount(flat, to_seen[:, d], CLASSES + 1) for d in range(WIDTH)], axis=1)
    bias = np.stack([np.bincount(high, to_columns[:, d], SIDE) for d in range(SIDE)], axis=1)
    return {
        "embed": embed, "mix": seen.T @ back, "lift": back.sum(axis=0),
        "row": hidden.T @ to_rows, "row_bias": to_rows.sum(axis=0),
        "column": hidden.T @ to_columns, "column_bias": bias,
    }


class Trainer:
    """Stochastic gradient descent with steps scaled by each weight's past slopes."""

    def __init__(self, net: dict[str, np.ndarray]):
        self.net = {name: w.copy() for name, w in net.items()}
        self.squares = {name: np.full(w.shape, 1e-6, np.float32) for name, w in net.items()}

    def step(self, around: np.ndarray, true: np.ndarray) -> None:
        for name, slope in gradients(self.net, around, true).items():
            self.squares[name] += (slope * slope).astype(np.float32)
            self.net[name] -= (RATE * slope / np.sqrt(self.squares[name])).astype(np.float32)


@dataclass
class Vocabulary:
    """Of each cell of hashed words its class, and the logarithm of its share of the class."""

    classes: np.ndarray
    shares: np.ndarray

    @classmethod
    def counted(cls, counts: np.ndarray) -> Vocabulary:
        classes = (CLASSES - RARE + np.arange(CELLS) % RARE).astype(np.int16)
        order = np.argsort(-counts, kind="stable")
        classes[order[: CLASSES - RARE]] = np.arange(CLASSES - RARE)
        weights = counts + 0.5
        shares = np.log(weights / np.bincount(classes, weights, CLASSES)[classes])
        return cls(classes, shares.astype(np.float32))

    def read(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word, and the logarithm of its share."""
        cells = (hashes % np.uint64(CELLS)).astype(np.int64)
        return self.classes[cells].astype(np.int64), self.shares[cells]


def _targets(first: np.ndarray, turn: int) -> np.ndarray:
    """The words to train on in a round: of each text every ROUNDS-th, of the next text the next."""
    places = np.arange(first[-1]) - np.repeat(first[:-1] + np.arange(len(first) - 1), np.diff(first))
    return np.flatnonzero(places % ROUNDS == turn)


def _around(classes: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Classes next to each word; the class after the last stands for beyond the text."""
    owner = np.searchsorted(first, at, side="right") - 1
    places = at[:, None] + np.array(_OFFSETS)
    inside = (places >= first[owner][:, None]) & (places < first[owner + 1][:, None])
    return np.where(inside, classes[np.clip(places, 0, len(classes) - 1)], CLASSES)


def vocabulary(docs: DataFrame) -> Vocabulary:
    """The vocabulary by counts over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        sums = np.zeros(CELLS, np.int64)
        for batch in batches:
            cells = [part.hashes(fold=True) % np.uint64(CELLS) for _, part in texts(batch.column(0))]
            if cells:
                sums += np.bincount(np.concatenate(cells).astype(np.int64), minlength=CELLS)
        return sums

    sums = totals(docs, count, np.int32)
    return Vocabulary.counted(np.zeros(CELLS) if sums is None else sums)


def fit(docs: DataFrame, text: str = "text") -> tuple[Vocabulary, dict[str, np.ndarray]]:
    """Vocabulary and network of the corpus."""
    rows = docs.select(F.col(text).cast("string").alias("text"))
    known, net = vocabulary(rows), start()
    for turn in range(ROUNDS):
        held = docs.sparkSession.sparkContext.broadcast((known, net, turn))

        def train(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
            known, begun, turn = held.value
            own, seen = Trainer(begun), 0
            for batch in batches:
                for _, part in texts(batch.column(0)):
                    classes, _ = known.read(part.hashes(fold=True))
                    # Words of the piece in a fixed random order.
                    at = _targets(part.first, turn)
                    at = np.random.default_rng(len(at)).permutation(at)
                    for some in np.array_split(at, -(-len(at) // BATCH)) if len(at) else ():
                        own.step(_around(classes, part.first, some), classes[some])
                    seen += len(at)
            return np.append(_packed(own.net) * float(seen), seen) if seen else None

        sums = totals(rows, train)
        if sums is None:
            break
        net = _unpacked(sums[:-1] / sums[-1])
    return known, net


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens, log_likelihood and mean_log_likelihood of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, net = held.value
        for batch in batches:
            counts, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, part in texts(batch.column(1)):
                classes, shares = known.read(part.hashes(fold=True))
                each = shares.astype(np.float64)
                for begin in range(0, len(classes), SCORED):
                    at = np.arange(begin, min(begin + SCORED, len(classes)))
                    each[at] += log_chances(net, _around(classes, part.first, at), classes[at])
                counts.append(np.diff(part.first))
                owner = np.repeat(np.arange(len(part)), counts[-1])
                sums.append(np.bincount(owner, each, len(part)))
            n, total = np.concatenate(counts), np.concatenate(sums)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total), mean], ["_key", "n_tokens", "log_likelihood", "mean_log_likelihood"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    shape = f"_key {kind}, n_tokens bigint, log_likelihood double, mean_log_likelihood double"
    return rows.mapInArrow(run, shape).withColumnRenamed("_key", key)
