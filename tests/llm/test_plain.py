"""Scores of models, sums and mixes against plain Python, without the arrays they are made with."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstar.llm import langid, mixing, sums, toxicity
from tests.llm.rows import LOWER, ODD, documents, words
from tests.llm.test_models import LABELS, prose

ALL = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mixed(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & ALL
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & ALL
    return x ^ x >> 33


def hashed(word: bytes):
    own = word.decode(errors="surrogateescape").translate(LOWER).encode(errors="surrogateescape")
    total = sum(mixed((b + 1) * BASE & ALL) * pow(BASE, i, 1 << 64) for i, b in enumerate(own))
    return mixed((total + len(own)) & ALL)


def softmax(values):
    top = max(values)
    e = [math.exp(v - top) for v in values]
    return [x / sum(e) for x in e]


def language(text, model):
    """lang_pred and score of a text, by the docstring alone."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    data = [b + 32 if 65 <= b <= 90 else 32 if b < 128 and not chr(b).isalpha() else b for b in text.encode()]
    data = [32, *data, 32]
    runs = []
    for i in range(len(data) - 2):
        if data[i] == data[i + 1] == 32:
            continue
        code = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
        runs.append(mixed(code) % langid.BUCKETS)
        if i + 3 < len(data):
            runs.append(mixed(code << 8 | data[i + 3] | 1 << 40) % langid.BUCKETS)
    mean = [sum(float(model.table[r][j]) for r in runs) / len(runs) + model.bias[j] for j in range(len(model.languages))]
    chances = softmax([m / model.temperature for m in mean])
    best = max(range(len(chances)), key=lambda j: chances[j])
    return model.languages[best], chances[best]


def test_languages_equal_plain_python(spark):
    rows = prose(250) + [(1000 + i, *r[1:]) for i, r in enumerate(ODD)] + [(2000, "A b", "aa", "s", 1), (2001, "  é", "bb", "s", 1)]
    docs = documents(spark, rows, extra=True)
    model = langid.fit(docs, langid.fold(4) != 2)
    texts = {r[0]: r[1] for r in rows}
    for r in langid.predict(docs, model).collect():
        name, score = language(texts[r["doc_id"]], model)
        assert r["lang_pred"] == name and r["score"] == pytest.approx(score, abs=1e-5)


def toxicity_of(text, model):
    clean = 0.0
    for sentence in re.split(rb"[.!?\n]", (text or "").encode()):
        found = re.findall(rb"[0-9A-Za-z\x80-\xff]+", sentence)
        if not found:
            continue
        logit = model.bias
        for word in found:
            logit += float(model.weights[hashed(word) % toxicity.BUCKETS])
            for size in toxicity.PREFIXES:
                if len(word) > size:
                    logit += float(model.weights[(hashed(word[:size]) ^ size) % toxicity.BUCKETS])
        clean += math.log1p(math.exp(logit)) if logit < 30 else logit
    if not clean:
        return 0.0
    return 1 / (1 + math.exp(-(model.scale * math.log(math.expm1(min(clean, 500))) + model.shift)))


def labelled(n=500):
    draw = random.Random(3)
    rows, labels = [], []
    for i, text, *rest in prose(n, 5):
        bad = draw.random() < 0.3
        rows.append((i, text + (". Vile Grockery you fremp! more" if bad else ". harmless words"), *rest))
        labels.append((i, int(bad), 0, "t", 1))
    return rows, labels


def test_toxicity_equals_plain_python(spark):
    rows, labels = labelled()
    rows += [(2000 + i, *r[1:]) for i, r in enumerate(ODD)] + [(3000, "vile", "en", "s", 1)]
    docs = documents(spark, rows, extra=True)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS), langid.fold(3) != 1)
    texts = {r[0]: r[1] for r in rows}
    scores = set()
    for r in toxicity.predict(docs, model).collect():
        scores.add(round(r["score"], 2))
        assert r["score"] == pytest.approx(toxicity_of(texts[r["doc_id"]], model), abs=1e-6)
    assert len(scores) > 3


def test_samples_are_bounded_in_words(spark, monkeypatch):
    rows, labels = labelled(200)
    rows.append((999, "word " * 50_000, "aa", "s", 1))
    docs, marks = documents(spark, rows), spark.createDataFrame([*labels, (999, 1, 0, "t", 1)], LABELS)
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda examples: seen.append([len(w) for _, w, _ in examples]))
    toxicity.fit(docs, marks, F.lit(True), sample_words=3000)
    monkeypatch.setattr(langid, "train", lambda examples: seen.append([len(b) for _, b, _ in examples]))
    langid.fit(docs, F.lit(True), sample_runs=3000)
    assert all(2500 < sum(found) <= 3000 and max(found) < 3000 for found in seen) and len(seen) == 2


def test_sums_of_all_tasks_in_a_fixed_order(spark, monkeypatch):
    monkeypatch.setattr(sums, "WIDTH", 1)
    rows = spark.range(0, 9_000, 1, 23).select(F.col("id").cast("double").alias("x"))

    def of(batches):
        values = np.concatenate([b.column(0).to_numpy() for b in batches])
        return np.array([values.sum(), len(values), (0.1 / (values + 1)).sum(), *range(40)])

    found = sums.totals(rows, of)
    assert found[:2].tolist() == [9_000 * 8_999 / 2, 9_000] and found[3:].tolist() == [23.0 * i for i in range(40)]
    for _ in range(3):
        assert (sums.totals(rows, of) == found).all()
    assert sums.totals(rows, lambda batches: np.array([sum(len(b) for b in batches)] * 3), np.int32).tolist() == [9_000] * 3
    assert sums.totals(rows.filter("x < 0"), lambda batches: None if not sum(map(len, batches)) else np.ones(3)) is None


def test_taken_words_equal_plain_python(spark):
    """Shards laid end to end in order of place, cut into blocks, and taken by quota."""
    draw = random.Random(7)
    rows = [(i, "w " * draw.choice([0, 1, 7, 60, 300]), "en", draw.choice(["a", "a", "b", None]), 1) for i in range(300)]
    got = mixing.mix(documents(spark, rows), shard_words=1500).collect()
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    block = max(1, min(min(sizes.values()) // 256, mixing.BLOCK_WORDS))
    shards = defaultdict(list)
    for r in got:
        shards[r["source"], r["shard"]].append(r)
    seats = round(sum({r["source"]: r["target"] for r in got}.values()) / block)
    taken, dealt = defaultdict(int), 0
    for (source, shard), own in shards.items():
        own.sort(key=lambda r: (r["place"], r["doc_id"], r["size"]))
        edges = np.cumsum([0, *(r["size"] for r in own)])
        blocks = int(-(-edges[-1] // block))
        got_words = [r["taken"] for r in own]
        taken[source] += sum(got_words)
        if not blocks:
            assert not any(got_words)
            continue
        # All blocks some times, and a run of blocks, around the end too, once more.
        about = round(sum(got_words) / block)
        fits = []
        for quota in range(max(0, about - 2), min(2 * blocks, about + 3) + 1):
            for first in range(blocks):
                times = np.full(blocks, quota // blocks)
                times[[(first + j) % blocks for j in range(quota % blocks)]] += 1
                each = np.repeat(times, block)[: edges[-1]]
                if [int(each[a:b].sum()) for a, b in zip(edges, edges[1:])] == got_words:
                    fits.append(quota)
        assert fits, (source, shard)
        dealt += fits[len(fits) // 2]
    assert abs(dealt - seats) <= len(shards)
    for source in sizes:
        target = next(r["target"] for r in got if r["source"] == source)
        assert abs(taken[source] - target) <= (2 + len(shards)) * block
