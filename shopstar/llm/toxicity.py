"""Toxicity by multiple-instance learning: sentence scores joined by a noisy-or.

Only documents are labelled. A sentence's probability is a logistic sum over its words and
their first three, four and five bytes, all hashed; a document is toxic if any sentence is, so its probability is one minus the product
of the sentences' complements. The weights are trained through that formula from document
labels, in numpy, on a bounded sample: `sample_rows` labelled rows in expectation, drawn by
a hash of the id, half of them toxic if there are as many, and of these, in the order of the
table, whole documents up to `sample_words` words in all. A fifth of the sample is kept
back to calibrate the documents' log-odds. Sentence scores then locate what made a document
toxic.

A sentence ends at `.`, `!`, `?`, a line feed or the text's end; words are runs of ASCII
letters, digits and bytes above 127, with A-Z as a-z. Null and empty texts score 0. Labels
that are null are not learnt from; of several labels of a document the largest counts. With
no labels of either kind every text scores 0. Texts count whole, and ids may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.llm.tidy import release
from shopstar.llm.words import FOLDED, Texts, spans_hash, texts

BUCKETS = 1 << 20
NONE = BUCKETS
PREFIXES = (3, 4, 5)
_WIDTH = 1 + len(PREFIXES)
SAMPLE_ROWS = 12_000
SAMPLE_WORDS = 1 << 24
LEAST_ROWS = 5
EPOCHS = 8
RATE = 0.2
DECAY = 1e-5
SURE = 1.96
_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


def sentences(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all words, the first word of each sentence, and each sentence's text.

    A word has a row of features: itself and its beginnings, or NONE where it is no longer
    than those. Sentences without a word do not appear; the first words have an end.
    """
    folded = FOLDED[part.data]
    words = [spans_hash(folded, part.starts, part.ends)]
    for size in PREFIXES:
        ends = np.minimum(part.starts + size, part.ends)
        words.append(spans_hash(folded, part.starts, ends) ^ np.uint64(size))
    features = (np.stack(words, axis=1) % np.uint64(BUCKETS)).astype(np.int64)
    lengths = part.ends - part.starts
    for column, size in enumerate(PREFIXES, 1):
        features[lengths <= size, column] = NONE
    ends = np.concatenate([[0], np.cumsum(_ENDS[part.data])])[part.starts]
    owner = np.repeat(np.arange(len(part)), np.diff(part.first))
    new = np.ones(len(features), bool)
    new[1:] = (ends[1:] != ends[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return features, np.concatenate([first, [len(features)]]), owner[first]


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def chance(self, clean: np.ndarray) -> np.ndarray:
        """Calibrated probability from minus the log of the chance that all is clean."""
        odds = np.log(np.maximum(np.expm1(np.minimum(clean, 500)), 1e-300))
        return np.where(clean > 0, _sigmoid(self.scale * odds + self.shift), 0.0)

    def logits(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(first) < 2:
            return np.zeros(0)
        each = self.weights[words].sum(axis=1, dtype=np.float64)
        return np.add.reduceat(each, first[:-1]) + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """Fit to (label, words, first word of each sentence and the end) of each document."""
    given = {label for label, words, _ in examples if len(words)}
    if given != {0, 1}:
        return None
    examples = sorted((x for x in examples if len(x[1])), key=lambda x: (x[0], len(x[1]), x[1][:8].astype(np.int64).tobytes()))
    draw = np.random.default_rng(seed)
    draw.shuffle(examples)
    kept_back = len(examples) // 5
    checks, examples = examples[:kept_back], examples[kept_back:]
    weights = _started(examples)
    used = weights > -np.inf
    weights[~used] = 0.0
    squares = np.full(BUCKETS + 1, 1e-2)
    bias, bias_square = -6.0, 1e-2
    for _ in range(EPOCHS):
        for i in draw.permutation(len(examples)):
            label, words, first = examples[i]
            logits = np.add.reduceat(weights[words].sum(axis=1), first[:-1]) + bias
            chances = _sigmoid(logits)
            clean = np.logaddexp(0, logits).sum()
            if label:
                toxic = -np.expm1(-clean)
                push = -chances * np.exp(-clean) / max(toxic, 1e-12)
            else:
                push = chances
            total = push.sum()
            if abs(total) < 1e-4:
                continue
            each = np.repeat(push, np.diff(first))
            live = used[words]
            own, place = np.unique(words[live], return_inverse=True)
            spread = np.broadcast_to(each[:, None], words.shape)[live]
            slope = np.bincount(place, spread, len(own)) + DECAY * weights[own]
            squares[own] += slope * slope
            weights[own] -= RATE * slope / np.sqrt(squares[own])
            bias_square += total * total
            bias -= RATE * 0.2 * total / np.sqrt(bias_square)
    return _calibrated(Model(weights.astype(np.float32), float(bias)), checks)


def _started(examples: list) -> np.ndarray:
    """First weights: how surely a feature speaks for toxic documents; -inf if too rare.

    The lower end of the confidence interval of its log odds ratio, at least 0.
    """
    rows = np.zeros((2, BUCKETS + 1))
    totals = np.zeros(2)
    for label, words, _ in examples:
        rows[label, np.unique(words)] += 1
        totals[label] += 1
    ratio = np.log((rows[1] + 0.5) / (rows[0] + 0.5)) - np.log((totals[1] + 1) / (totals[0] + 1))
    doubt = np.sqrt(1 / (rows[1] + 0.5) + 1 / (rows[0] + 0.5))
    weights = np.maximum(ratio - SURE * doubt, 0)
    weights[rows.sum(axis=0) < min(LEAST_ROWS, max(1, totals.sum() // 20))] = -np.inf
    weights[NONE] = -np.inf
    return weights


def _calibrated(model: Model, checks: list, steps: int = 50) -> Model:
    """Fit scale and shift of the log-odds by logistic regression with smoothed targets."""
    truth = np.array([label for label, _, _ in checks])
    if len(set(truth.tolist())) < 2:
        return model
    clean = np.array([np.logaddexp(0, model.logits(words, first)).sum() for _, words, first in checks])
    odds = np.log(np.maximum(np.expm1(np.minimum(clean, 500)), 1e-300))
    toxic, rest = truth.sum(), (1 - truth).sum()
    target = np.where(truth == 1, (toxic + 1) / (toxic + 2), 1 / (rest + 2))
    rows = np.stack([odds, np.ones(len(odds))], axis=1)
    fitted = np.array([1.0, 0.0])
    for _ in range(steps):
        chances = _sigmoid(rows @ fitted)
        slope = rows.T @ (chances - target) + 1e-3 * (fitted - [1.0, 0.0])
        bend = (rows * (chances * (1 - chances))[:, None]).T @ rows + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        fitted -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    if fitted[0] > 0:
        model.scale, model.shift = float(fitted[0]), float(fitted[1])
    return model


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS, sample_words: int = SAMPLE_WORDS
) -> Model | None:
    """Train on a sample of the labelled rows for which `learn`, over doc_id, holds.

    The sample's ids are broadcast: their number is bounded by sample_rows. A document that
    would bring the sample above sample_words is passed over, whole.
    """
    known = labels.filter(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    toxic = min(counts[1], sample_rows // 2)
    wanted = {1: toxic, 0: min(counts[0], sample_rows - toxic)}
    places = 1 << 30
    chance = F.when(F.col("label") == 1, F.lit(places * wanted[1] // counts[1])).otherwise(F.lit(places * wanted[0] // counts[0]))
    sample = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(places)) < chance)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in texts(batch.column(1), _BREAKS):
                words, first, owner = sentences(part)
                begin = np.searchsorted(owner, np.arange(len(part) + 1))
                bags, cuts = [], []
                for i in range(len(part)):
                    own = first[begin[i] : begin[i + 1] + 1] if begin[i + 1] > begin[i] else first[:0]
                    bags.append(words[own[0] : own[-1]].astype(np.int32).tobytes() if len(own) else b"")
                    cuts.append((own - own[0]).astype(np.int32).tobytes() if len(own) else b"")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(part)), pa.array(bags, pa.binary()), pa.array(cuts, pa.binary())], ["label", "words", "first"])

    found = rows.select(F.col("label").cast("int"), "text").mapInArrow(read, "label int, words binary, first binary")
    examples, left = [], sample_words
    for r in found.toLocalIterator():
        words = np.frombuffer(r["words"], np.int32).reshape(-1, _WIDTH)
        if len(words) <= left:
            left -= len(words)
            examples.append((r["label"], words, np.frombuffer(r["first"], np.int32).astype(np.int64)))
    model = train(examples)
    examples.clear()
    release()
    return model


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score, n_sentences, and the place and score of the worst sentence.

    worst_start and worst_end are byte offsets of its words, null where there is no sentence.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for _, part in texts(batch.column(1), _BREAKS):
                words, first, owner = sentences(part)
                counts = np.bincount(owner, minlength=len(part))
                if held.value is None:
                    logits = np.full(len(owner), -np.inf)
                else:
                    logits = held.value.logits(words, first)
                clean = np.bincount(owner, np.logaddexp(0, logits), len(part))
                order = np.lexsort((-logits, owner))
                lead = order[np.searchsorted(owner, np.arange(len(part)))[counts > 0]]
                low = np.where(counts > 0, 0, -1)
                start, end, worst = low.copy(), low.copy(), np.zeros(len(part))
                base = part.bounds[:-1][counts > 0]
                start[counts > 0] = part.starts[first[lead]] - base
                end[counts > 0] = part.ends[first[lead + 1] - 1] - base
                worst[counts > 0] = _sigmoid(logits[lead])
                chance = np.zeros(len(part)) if held.value is None else held.value.chance(clean)
                for held_column, values in zip(columns, (chance, counts, start, end, worst)):
                    held_column.append(values)
            if columns[0]:
                score, counts, start, end, worst = (np.concatenate(c) for c in columns)
                none = counts == 0
                arrays = [pa.array(score), pa.array(counts, pa.int64()), pa.array(start, pa.int64(), mask=none), pa.array(end, pa.int64(), mask=none), pa.array(worst, mask=none)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["_key", "score", "n_sentences", "worst_start", "worst_end", "worst_score"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    shape = f"_key {kind}, score double, n_sentences bigint, worst_start bigint, worst_end bigint, worst_score double"
    return rows.mapInArrow(run, shape).withColumnRenamed("_key", key)
