from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstar.llm import langid, lm, toxicity
from tests.llm.rows import ODD, documents

SYLLABLES = {"aa": ["ka", "to", "mi", "ru", "shi"], "bb": ["über", "sch", "ein", "ung", "zz"], "cc": ["qué", "ll", "ión", "os", "ez"]}
LABELS = "doc_id bigint, toxic int, quality int, text string, label int"


def sentence(draw, name, n=12):
    return " ".join("".join(draw.choices(SYLLABLES[name], k=draw.randint(2, 4))) for _ in range(n))


def prose(n, seed=1):
    draw = random.Random(seed)
    return [(i, ". ".join(sentence(draw, name) for _ in range(draw.randint(1, 6))), name, "s", 1) for i in range(n) for name in [draw.choice([*SYLLABLES])]]


def test_languages_held_out(spark):
    docs = documents(spark, prose(400), extra=True)
    model = langid.fit(docs, langid.fold(4) != 2)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(langid.fold(4) == 2).collect()
    assert len(rows) > 60
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.02 * len(rows)


def test_rejection_of_other_scripts_and_odd_rows(spark):
    docs = documents(spark, prose(300))
    model = langid.fit(docs, F.lit(True))
    odd = documents(spark, [*ODD, (50, "привет мир это не тот язык совсем", None, None, 1), (51, "12 + 34 %", None, None, 1), (52, "é", None, None, 1)], extra=True)
    got = {}
    for r in langid.predict(odd, model).collect():
        got.setdefault(r["doc_id"], r)
    for i in (1, 2, 3, 51):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    for i in (4, 5, 8, 52):
        assert got[i]["lang_pred"] in SYLLABLES
    assert got[50]["rejected"]
    assert langid.accepted(odd, model).columns == odd.columns
    assert langid.accepted(docs, model).count() >= 295


def test_nothing_to_learn_languages_from(spark):
    none = documents(spark, [])
    assert langid.fit(none, F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.predict(documents(spark), None).collect()} == {"und"}
    assert langid.predict(none, None).count() == 0
    one = documents(spark, [(1, "word", "en", "s", 1)])
    assert langid.predict(one, langid.fit(one, F.lit(True))).first()["lang_pred"] == "en"


def test_prediction_ignores_other_columns(spark):
    docs = documents(spark, prose(200))
    model = langid.fit(docs, F.lit(True))
    bare = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x")})
    assert langid.predict(docs, model).collect() == langid.predict(bare, model).collect()


def tainted(n, seed=3):
    draw = random.Random(seed)
    bad = ["vileone", "viletwo", "nastyish", "grimly"]
    docs, labels, marks = [], [], {}
    for i in range(n):
        lines = [sentence(draw, "aa", 8) for _ in range(draw.randint(1, 8))]
        toxic = int(draw.random() < 0.25)
        if toxic:
            at = draw.randrange(len(lines))
            lines[at] += " " + " ".join(draw.choices(bad, k=2))
            marks[i] = lines[at]
        docs.append((i, ". ".join(lines) + ".", "aa", "s", 1))
        labels.append((i, toxic, 1, "x", 0))
    return docs, labels, marks


def test_toxicity_held_out_and_located(spark):
    rows, marks_of, where = tainted(900)
    docs, labels = documents(spark, rows, extra=True), spark.createDataFrame(marks_of, LABELS)
    model = toxicity.fit(docs, labels, langid.fold(3) != 1)
    truth = {i: t for i, t, *_ in marks_of}
    got = toxicity.predict(docs, model).filter(langid.fold(3) == 1).collect()
    caught = [r for r in got if truth[r["doc_id"]] and r["score"] >= 0.7]
    assert len(caught) >= 0.95 * sum(truth[r["doc_id"]] for r in got)
    assert not [r for r in got if not truth[r["doc_id"]] and r["score"] >= 0.7]
    text = {i: t.encode() for i, t, *_ in rows}
    hits = [text[r["doc_id"]][r["worst_start"] : r["worst_end"]].decode() == where[r["doc_id"]] for r in caught]
    assert sum(hits) >= 0.95 * len(hits)


def test_toxicity_of_odd_rows(spark):
    rows, marks, _ = tainted(200)
    labels = spark.createDataFrame([*marks, (None, 1, 1, "", 1), (3, None, 1, "", 1), (5, 1 - marks[5][1], 0, "", 1)], LABELS)
    model = toxicity.fit(documents(spark, rows + ODD), labels, F.lit(True))
    got = toxicity.predict(documents(spark, extra=True), model).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert (r["n_sentences"] == 0) == (r["worst_start"] is None)
        assert r["doc_id"] not in (1, 2, 3) or r["score"] == 0


def test_nothing_to_learn_toxicity_from(spark):
    docs, none = documents(spark), spark.createDataFrame([], LABELS)
    assert toxicity.fit(docs, none, F.lit(True)) is None
    assert toxicity.fit(docs, spark.createDataFrame([(4, 1, 1, "", 1)], LABELS), F.lit(True)) is None
    assert {r["score"] for r in toxicity.predict(docs, None).collect()} == {0.0}
    assert toxicity.predict(documents(spark, []), None).count() == 0


def test_slopes_of_the_network():
    draw = np.random.default_rng(1)
    net = {name: w.astype(np.float64) + 0.1 * draw.standard_normal(w.shape) for name, w in lm.start().items()}
    around, true = draw.integers(0, lm.CLASSES + 1, (40, 2 * lm.REACH)), draw.integers(0, lm.CLASSES, 40)
    slopes = lm.gradients(net, around, true)
    for name, slope in slopes.items():
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        moved = []
        for step in (1e-5, -1e-5):
            other = {k: v.copy() for k, v in net.items()}
            other[name][at] += step
            moved.append(-lm.log_chances(other, around, true).mean())
        assert slope[at] == pytest.approx((moved[0] - moved[1]) / 2e-5, rel=1e-4)


def test_chances_add_up():
    net = lm.start()
    around = np.full((lm.CLASSES, 2 * lm.REACH), 3)
    assert np.exp(lm.log_chances(net, around, np.arange(lm.CLASSES)).astype(np.float64)).sum() == pytest.approx(1, abs=1e-4)


def test_order_of_words_is_learnt_from_both_sides(spark):
    draw = random.Random(2)
    verse = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(600):
        starts = [draw.randrange(38) for _ in range(60)]
        own = [w for at in starts for w in verse[at : at + 3]]
        rows.append((i, " ".join(own), "en", "s", 1))
    docs = documents(spark, rows, extra=True)
    model = lm.fit(docs)
    text = rows[0][1].split()
    mixed = draw.sample(text, len(text))
    probe = documents(spark, [(1, " ".join(text), "en", "s", 1), (2, " ".join(mixed), "en", "s", 1)])
    got = {r["doc_id"]: r for r in lm.score(probe, model).collect()}
    untrained = {r["doc_id"]: r for r in lm.score(probe, (model[0], lm.start())).collect()}
    assert got[1]["mean_log_likelihood"] > got[2]["mean_log_likelihood"] + 0.3
    assert got[1]["mean_log_likelihood"] > untrained[1]["mean_log_likelihood"] + 1
    assert got[1]["log_likelihood"] == pytest.approx(got[1]["mean_log_likelihood"] * 180, rel=1e-6)


def test_scores_equal_those_word_by_word(spark):
    docs = documents(spark, prose(30) + ODD, extra=True)
    known, net = lm.fit(docs)
    import pyarrow as pa

    from shopstar.llm.words import texts

    for r, (doc_id, text, *_) in zip(lm.score(documents(spark, prose(5)), (known, net)).collect(), prose(5)):
        (_, part), = texts(pa.array([text]))
        own, shares = known.read(part.hashes(fold=True))
        padded = [lm.CLASSES] * lm.REACH + own.tolist() + [lm.CLASSES] * lm.REACH
        total = 0.0
        for i, c in enumerate(own):
            near = padded[i : i + lm.REACH] + padded[i + lm.REACH + 1 : i + 2 * lm.REACH + 1]
            total += float(lm.log_chances(net, np.array([near]), np.array([c]))[0]) + float(shares[i])
        assert r["log_likelihood"] == pytest.approx(total, rel=1e-4)
    got = lm.score(docs, (known, net)).collect()
    assert len(got) == 30 + len(ODD)
    assert all((r["n_tokens"] == 0) == (r["mean_log_likelihood"] is None) for r in got)


def test_shares_of_a_class_add_up():
    draw = np.random.default_rng(1)
    counts = draw.zipf(1.3, lm.CELLS).clip(0, 10**6) - 1
    known = lm.Vocabulary.counted(counts)
    sums = np.bincount(known.classes, np.exp(known.shares.astype(np.float64)), lm.CLASSES)
    assert np.allclose(sums, 1, atol=1e-3) and (known.shares <= 0).all()
    alone = np.flatnonzero(known.classes < lm.CLASSES - lm.RARE)
    assert len(alone) == lm.CLASSES - lm.RARE and not known.shares[alone].any()
    # In one class the more frequent cell has the larger share.
    own = np.flatnonzero(known.classes == lm.CLASSES - 1)
    order = np.argsort(counts[own])
    assert (np.diff(known.shares[own][order]) >= 0).all()


def test_the_same_split_gives_the_same_scores(spark):
    docs = documents(spark, prose(60)).repartition(5, "doc_id")
    both = [sorted(map(tuple, lm.score(docs, lm.fit(docs)).collect())) for _ in range(2)]
    assert both[0] == both[1]


def test_every_word_is_a_target_once():
    first = np.array([0, 0, 1, 3, 12, 40])
    turns = [lm._targets(first, turn) for turn in range(lm.ROUNDS)]
    assert sorted(np.concatenate(turns).tolist()) == list(range(40))


def test_words_at_every_place_are_learnt(spark):
    """The second of two words stands at no place that is a multiple of four."""
    docs = spark.range(0, 60000, 1, 1).selectExpr("id as doc_id", "'lead tail' as text")
    model = lm.fit(docs)
    assert lm.score(docs.limit(1), model).first()["log_likelihood"] > -2


def test_no_text_to_model(spark):
    none = documents(spark, [])
    assert lm.score(none, lm.fit(none)).count() == 0
    assert lm.fit(documents(spark, [(1, None, None, None, None)]))[1].keys() == lm.start().keys()
