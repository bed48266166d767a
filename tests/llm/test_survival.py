from __future__ import annotations

from itertools import permutations

import numpy as np

from shopstar.llm import survival
from tests.llm.rows import ODD, documents, keyed, words

LABELS = "doc_id bigint, quality int, toxic int"


def failed(docs):
    firsts = {}
    for doc in docs:
        if doc[0] is not None:
            firsts[doc[1] or ""] = min(doc[0], firsts.get(doc[1] or "", doc[0]))
    for doc in docs:
        text, own = doc[1] or "", words(doc[1])
        letters = "A" * (len(own) < 200) + "B" * (100 * len(set(own)) < 50 * len(own))
        letters += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text))
        letters += "D" * any(c in text for c in "#$%&*|")
        letters += "E" * (doc[0] is not None and firsts[text] < doc[0])
        yield doc[2] or "", doc[0], set(letters)


def expected(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = list(failed(docs))
    out, shapley = [], {}
    for part in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                here = [r for r in left if letter in r[2]]
                left = [r for r in left if letter not in r[2]]
                fails = [r for r in own if letter in r[2]]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(here)
                alone = sum(r[2] == {letter} for r in own)
                lost = [sum(r[1] in marked for r in here) for marked in (good, toxic)]
                out.append((part, "".join(order), step, letter, len(left), len(here), len(fails) - len(here), alone, *lost))
    return [(*r, shapley[r[0], r[3]]) for r in out]


def audit(spark, docs, labels, extra=False):
    return [tuple(r) for r in survival.audit(documents(spark, docs, extra), spark.createDataFrame(labels, LABELS)).collect()]


MADE = [
    (10, "a b " * 60, "en", "a", 0),
    (11, "a b " * 60, "de", "a", 0),
    (12, " ".join(f"w{i}" for i in range(200)), "en", "a", 0),
    (13, " ".join(f"w{i}" for i in range(200)), "en", "a", 0),
    (13, " ".join(f"w{i}" for i in range(200)), "en", "a", 0),
    (14, " ".join(f"W{i}" for i in range(100)) + " " + " ".join(f"w{i}" for i in range(100)), "", "a", 0),
    (15, " ".join(f"é{i}|" for i in range(250)), "fr", "a", 0),
    (None, " ".join(f"w{i}" for i in range(200)), "en", "a", 0),
]
MARKS = [(1, 1, 0), (5, 1, 1), (6, None, 1), (13, 0, 1), (13, 1, 0), (12, 1, None), (None, 1, 1), (99, 1, 1)]


def test_equals_brute_force_on_odd_rows(spark):
    want = expected(ODD + MADE, MARKS)
    for extra in (False, True):
        assert keyed(audit(spark, ODD + MADE, MARKS, extra)) == keyed(want)
    assert {r[0] for r in want} == {"", "en", "de", "fr"}
    assert len(want) == 600 * 4


def test_empty_tables(spark):
    assert audit(spark, [], MARKS) == []
    assert keyed(audit(spark, ODD, [])) == keyed(expected(ODD, []))


def test_positional_popcount():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 5, 100, 4097):
        words = draw.integers(0, 1 << 32, n, dtype=np.uint32)
        want = [int((words >> np.uint32(i) & 1).sum()) for i in range(32)]
        assert survival.positional_popcount(words).tolist() == want


def test_words_hold_the_truth_table():
    for fails in range(32):
        for subset in range(32):
            assert bool(survival.WORDS[fails] >> subset & 1) == (not fails & subset)


def test_many_parts_and_flushes(spark, monkeypatch):
    docs = [(i, f"w{i % 7} " * (i % 300), f"l{i % 40}", "a", 0) for i in range(400)]
    rows = audit(spark, docs, [])
    assert keyed(rows) == keyed(expected(docs, []))
