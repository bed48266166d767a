"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's letters are read as overlapping runs of three and four bytes, spaces standing for
everything else in ASCII. Runs hash to buckets; the text is the average of their embeddings,
and a linear softmax over it gives the language. Embeddings and softmax are trained together
by stochastic gradient descent in numpy on a bounded sample, `sample_rows` labelled rows in
all (in expectation; drawn by a hash of the id, as many of each language), and of these, in the
order of the table, whole texts up to `sample_runs` different subwords in all, a text's own
counted. A fifth of it is kept back to calibrate: a temperature brings the probabilities in line with the accuracy,
and a text is rejected if its language is less likely than not, or if far fewer of its
subwords are known than in any text kept back.

Null texts, and texts without a letter, are `und` with score 0 and rejected. Rows without a
language are scored, not learnt from. Ids may repeat. With no labelled row every text is
`und`. Texts count whole; columns other than those named are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstar.llm.tidy import release, tidy
from shopstar.llm.words import Texts, mix, texts

UNKNOWN = "und"
BUCKETS = 1 << 16
WIDTH = 16
SAMPLE_ROWS = 5000
SAMPLE_RUNS = 1 << 25
EPOCHS = 6
RATE = 4.0
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
_ASCII_LETTER = np.array([chr(b).isalpha() if b < 128 else False for b in range(256)])


def subwords(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs in the texts, and where each text's runs begin, with the end."""
    sizes = np.diff(part.bounds)
    padded = np.full(len(part.data) + 2 * len(part), 32, np.uint64)
    padded[np.arange(len(part.data)) + np.repeat(2 * np.arange(len(part)) + 1, sizes)] = _FOLD[part.data]
    last = np.concatenate([[0], np.cumsum(sizes + 2)])
    code = padded[:-2] << np.uint64(16) | padded[1:-1] << np.uint64(8) | padded[2:]
    blank = (padded[:-2] == 32) & (padded[1:-1] == 32)
    three = mix(code) % np.uint64(BUCKETS)
    four = mix(code[:-1] << np.uint64(8) | padded[3:] | np.uint64(1 << 40)) % np.uint64(BUCKETS)
    # A run that would reach into the next text belongs to none.
    left = np.repeat(last[1:], sizes + 2)[: len(code)] - np.arange(len(code))
    ok3, ok4 = (left >= 3) & ~blank, ((left >= 4) & ~blank)[:-1]
    at = np.concatenate([np.flatnonzero(ok3), np.flatnonzero(ok4)])
    found = np.concatenate([three[ok3], four[ok4]]).astype(np.int64)
    order = np.argsort(at, kind="stable")
    return found[order], np.searchsorted(at[order], last)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    known: np.ndarray
    least_known: float
    temperature: float
    least_score: float

    def scores(self, buckets: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probabilities of each text, and the known share of its runs."""
        counts = np.maximum(np.diff(begin), 1)[:, None]
        sums = _sum_rows(self.table[buckets], begin) / counts + self.bias
        return _softmax(sums / self.temperature), _sum_rows(self.known[buckets][:, None], begin)[:, 0] / counts[:, 0]


def _sum_rows(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    full = np.flatnonzero(np.diff(begin))
    out = np.zeros((len(begin) - 1, rows.shape[1]))
    if len(full):
        out[full] = np.add.reduceat(rows, begin[full], axis=0, dtype=np.float64)
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(examples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """Fit to (language, distinct buckets of the text, their counts), in any order."""
    languages = sorted({name for name, _, _ in examples})
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    own = {name: i for i, name in enumerate(languages)}
    examples = sorted(examples, key=lambda x: (x[0], len(x[1]), x[1][:64].tobytes()))
    whole = [(own[name], buckets, counts) for name, buckets, counts in examples if len(buckets)]
    draw.shuffle(whole)
    kept_back = max(1, len(whole) // 5) if len(whole) > 20 else 0
    checks, learnt = whole[:kept_back], whole[kept_back:]
    # Short pieces of the same texts teach short texts.
    short = []
    for name, buckets, counts in learnt:
        size = int(draw.integers(4, 40))
        some = draw.choice(buckets, min(size, len(buckets)), p=counts / counts.sum())
        short.append((name, *np.unique(some, return_counts=True)))
    both = learnt + short
    embed = draw.normal(0, 0.1, (BUCKETS, WIDTH))
    weight, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    steps, done = EPOCHS * len(both), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(len(both)):
            name, buckets, counts = both[i]
            rate = RATE * (1 - done / steps)
            done += 1
            share = counts / counts.sum()
            mean = share @ embed[buckets]
            error = _softmax(mean @ weight + bias)
            error[name] -= 1
            back = weight @ error
            weight -= rate * 0.1 * np.outer(mean, error)
            bias -= rate * 0.01 * error
            embed[buckets] -= rate * share[:, None] * back
    seen = np.zeros(BUCKETS, bool)
    for _, buckets, _ in learnt:
        seen[buckets] = True
    model = Model(languages, (embed @ weight).astype(np.float32), bias, seen.astype(np.float32), 0.0, 1.0, 0.5)
    return _calibrated(model, checks or learnt)


def _calibrated(model: Model, checks: list) -> Model:
    """Set the temperature by likelihood, and the least known share by the texts kept back."""
    if not checks:
        return model
    truth = np.array([n for n, _, _ in checks])
    share = [c / c.sum() for _, _, c in checks]
    logits = np.array([s @ model.table[b] for s, (_, b, _) in zip(share, checks)]) + model.bias
    losses = {}
    for t in np.geomspace(0.1, 20, 60):
        p = _softmax(logits / t)[np.arange(len(truth)), truth]
        losses[t] = -np.log(np.maximum(p, 1e-12)).mean()
    model.temperature = float(min(losses, key=losses.get))
    model.least_known = 0.5 * float(min(s @ model.known[b] for s, (_, b, _) in zip(share, checks)))
    return model


def fit(docs: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS, sample_runs: int = SAMPLE_RUNS) -> Model | None:
    """Train on a sample of the rows for which `learn` holds and text and language are known.

    A text that would bring the sample above sample_runs is passed over, whole.
    """
    usable = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    each = max(20, sample_rows // len(counts))
    places = 1 << 30
    chance = F.lit(0)
    for name, n in counts.items():
        chance = F.when(F.col("lang") == name, F.lit(places if n <= each else places * each // n)).otherwise(chance)
    sample = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(places)) < chance)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in texts(batch.column(1)):
                found, begin = subwords(part)
                bags = [np.unique(found[i:j], return_counts=True) for i, j in zip(begin, begin[1:])]
                runs = [buckets.astype(np.uint16).tobytes() for buckets, _ in bags]
                counts = [number.astype(np.uint32).tobytes() for _, number in bags]
                arrays = [pa.array(runs, pa.binary()), pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(part)), *arrays], ["lang", "runs", "counts"])

    rows = sample.select("lang", "text").mapInArrow(read, "lang string, runs binary, counts binary").toLocalIterator()
    examples, left = [], sample_runs
    for r in rows:
        runs = np.frombuffer(r["runs"], np.uint16)
        if len(runs) <= left:
            left -= len(runs)
            examples.append((r["lang"], runs, np.frombuffer(r["counts"], np.uint32)))
    model = train(examples)
    examples.clear()
    release()
    return model


def judge(column: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated score and rejection of every text of a column."""
    names, scores, out = [], [np.zeros(0)], [np.zeros(0, bool)]
    for _, part in texts(column):
        letters = _sum_rows(_ASCII_LETTER[part.data][:, None].astype(np.int32), part.bounds)[:, 0] > 0
        for i in np.flatnonzero(~letters):
            raw = part.data[part.bounds[i] : part.bounds[i + 1]].tobytes()
            letters[i] = bool(_LETTER.search(raw.decode(errors="ignore")))
        if model is None:
            names += [UNKNOWN] * len(part)
            scores.append(np.zeros(len(part)))
            out.append(np.ones(len(part), bool))
            continue
        chances, known = model.scores(*subwords(part))
        best = chances.argmax(axis=1)
        names += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
        top = np.where(letters, chances.max(axis=1), 0.0)
        scores.append(top)
        out.append((top < model.least_score) | (known < model.least_known))
    return names, np.concatenate(scores), np.concatenate(out)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, lang_pred, score and rejected of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, out = judge(batch.column(1), held.value)
            arrays = [pa.array(names, pa.string()), pa.array(scores), pa.array(out)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["_key", "lang_pred", "score", "rejected"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    shape = f"_key {kind}, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(tidy(run), shape).withColumnRenamed("_key", key)


def accepted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~judge(batch.column(at), held.value)[2]))

    return docs.mapInArrow(tidy(run), docs.schema)


def fold(modulus: int, key: str = "doc_id") -> Column:
    """Remainder of the id's checksum, by which rows are held out; null for a null id."""
    return F.crc32(F.col(key).cast("string")) % modulus
