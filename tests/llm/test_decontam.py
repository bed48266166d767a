from __future__ import annotations

import hashlib
import random
import re

import pytest

from shopstar.llm import decontam
from tests.llm.rows import LOWER, ODD, documents, keyed

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def tokens(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, size):
    windows = {}
    for item, text in items:
        own = tokens(text)
        m = min(len(own), size)
        for i in range(len(own) - m + 1 if m else 0):
            windows.setdefault(tuple(own[i : i + m]), set()).add(item)
    out = []
    for doc in docs:
        own, hit, found = tokens(doc[1]), set(), set()
        for i in range(len(own)):
            for m in range(1, size + 1):
                if tuple(own[i : i + m]) in windows and i + m <= len(own):
                    hit.update(range(i, i + m))
                    found |= windows[tuple(own[i : i + m])]
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc[0], len(own), len(hit), len(names), digest, bool(hit)))
    return out


def table(spark, items):
    return spark.createDataFrame(items, ITEMS)


def drawn(seed, n_docs=60, n_items=25):
    """Texts over few words, so that windows overlap, repeat, and share first and last blocks."""
    draw = random.Random(seed)
    vocabulary = ["a", "B", "c9", "été", "Ω", "x" * 50]
    text = lambda most: " ,".join(draw.choice(vocabulary) for _ in range(draw.randrange(most)))
    items = [(i, text(12)) for i in range(n_items)]
    docs = [(i, text(700 if i == 0 else 80), "en", "a", 0) for i in range(n_docs)]
    docs += [(100 + i, f"{text(9)}. {t.upper()}! {text(9)}", "en", "a", 0) for i, t in items]
    return docs, items


@pytest.mark.parametrize("size", [1, 2, 4, 10])
def test_equals_brute_force(spark, size):
    docs, items = drawn(size)
    out = decontam.digests(documents(spark, docs), table(spark, items), size)
    assert keyed(map(tuple, out.collect())) == keyed(expected(docs, items, size))


def test_rounds_over_shards_find_the_same(spark):
    docs, items = drawn(5)
    whole = decontam.contamination(documents(spark, docs), table(spark, items), 4)
    rounds = decontam.contamination(documents(spark, docs), table(spark, items), 4, shard_bytes=300)
    assert rounds.schema.simpleString() == whole.schema.simpleString()
    assert keyed(map(str, rounds.collect())) == keyed(map(str, whole.collect()))


def test_spans_and_items(spark):
    out = decontam.contamination(
        documents(spark, [(1, "x one TWO-three y one two z", "en", "a", 0)]), table(spark, [(10, "One two"), (9, "two three"), (9, "q")]), 2
    )
    row = out.first()
    assert [tuple(s) for s in row["spans"]] == [(1, 4), (5, 7)]
    assert row["items"] == ["10", "9"]


def test_odd_rows_and_items(spark):
    items = [(1, "one two"), (1, "one two"), (2, "ONE; two"), (None, "some words"), (3, None), (4, ""), (5, "..."), (6, "word " * 30), (7, "x" * 20000)]
    for extra in (False, True):
        out = decontam.digests(documents(spark, extra=extra), table(spark, items).selectExpr("*", "1 as spans", "2 as doc_id"))
        assert keyed(map(tuple, out.collect())) == keyed(expected(ODD, items, 10))


def test_empty_tables(spark):
    nothing = decontam.digests(documents(spark), table(spark, []))
    assert keyed(map(tuple, nothing.collect())) == keyed(expected(ODD, [], 10))
    assert decontam.digests(documents(spark, []), table(spark, [(1, "one")])).collect() == []


def test_jumps_pass_over_words():
    patterns = decontam.Patterns([1], [" ".join(f"p{i}" for i in range(10))])
    text = " ".join(f"w{i}" for i in range(2000)).encode()
    import numpy as np

    part = decontam.Texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]), decontam.BREAKS)
    looked_at = []
    blocks = decontam._blocks
    try:
        decontam._blocks = lambda hashes, at, size: looked_at.append(len(at)) or blocks(hashes, at, size)
        assert not patterns.mark(part)[0].any()
    finally:
        decontam._blocks = blocks
    assert sum(looked_at) < 2000 / 7
