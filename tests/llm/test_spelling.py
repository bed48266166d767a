from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shopstar.llm import spelling
from shopstar.sources.scratch import Scratch
from tests.llm.rows import LOWER, ODD, documents, keyed

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs, least_length=7, least_count=2, divisor=31):
    found = Counter()
    for doc in docs:
        for run in RUN.findall(doc[1] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc[0] is None else doc[0]}:{run}".encode())
            if h % divisor == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def edited(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected(counts, times=10):
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and edited(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def drawn(seed, n=1500):
    """Words over few letters with many variants, counts far apart, and chains of forms."""
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abcdéÿ") for _ in range(draw.randrange(6, 12))) for _ in range(40)]
    stems += ["lettersinwordsthatareverylong" * 3, "z" * 50, "z" * 51]
    texts = []
    for i in range(n):
        word = draw.choice(stems[: 1 + int(len(stems) * draw.random() ** 2)])
        for _ in range(draw.choice([0, 0, 0, 0, 1, 1, 2])):
            place = draw.randrange(len(word))
            word = word[:place] + draw.choice(["", "a", "ß", "bx"]) + word[place + draw.randrange(2) :]
        texts.append(draw.choice([word, word.upper()]) + draw.choice([" ", "9", "-", " × "]))
    chain = "chaining " * 800 + "chainingé " * 60 + "chainingéé " * 4
    return [(i, "".join(texts[i :: n // 30]), "en", "a", 0) for i in range(n // 30)] + [(1000 + i, chain, "en", "a", 0) for i in range(3)]


def rows(frame):
    return keyed(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_equals_brute_force(spark):
    docs = drawn(1) + ODD
    want = expected(counted(docs))
    assert any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)
    for extra in (False, True):
        assert rows(spelling.variants(documents(spark, docs, extra))) == keyed(want)


@pytest.mark.parametrize("limits", [{"trie_words": 20, "block_words": 30}, {"trie_words": 7, "block_words": 10**6, "n_groups": 6}])
def test_small_tries_find_the_same(spark, limits):
    docs = drawn(2)
    found = spelling.variants(documents(spark, docs), least_length=2, divisor=3, form_times=2, **limits)
    assert rows(found) == keyed(expected(counted(docs, 2, 2, 3), 2))


def test_chain_of_forms(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "bbcdefghij": 2000}
    with Scratch(spark) as scratch:
        words = scratch.keep(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
        found = spelling.near_words(words, scratch)
        forms = found.filter("form_n >= 10 * n")
        got = {r["word"]: r["root"] for r in spelling.roots(forms, scratch).collect()}
    assert got == {"abcdefg": "abcdefghij", "abcdefgh": "abcdefghij", "abcdefghi": "abcdefghij"}


def test_ties_go_to_the_smallest_word(spark):
    counts = {"aaaaaaa": 1, "aaaaaab": 30, "aaaaaaÿ": 30, "aaaaaac": 29}
    with Scratch(spark) as scratch:
        words = scratch.keep(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
        found = {r["word"]: r for r in spelling.near_words(words, scratch, trie_words=1).collect()}
    assert found["aaaaaaa"]["form"] == "aaaaaab" and found["aaaaaaa"]["n_near"] == 3


def test_words_alike_in_all_counts_are_split(spark):
    draw = random.Random(4)
    words = sorted({"".join(draw.sample("abcdefgh", 8)) for _ in range(300)} | {"".join(draw.sample("abcdefgh", 7)) for _ in range(300)})
    with Scratch(spark) as scratch:
        kept = scratch.keep(spark.createDataFrame([(w, 2) for w in words], "word string, n bigint"))
        group = spelling.letter_groups(kept)
        cut = spelling.Cut(spelling._cells(kept, group), 25, 25)
        sizes = spelling._sent(kept, group, cut).groupBy("trie").count().toPandas()["count"]
        assert len(sizes) > 30 and sizes.max() < 150
        found = spelling.near_words(kept, scratch, trie_words=25, block_words=25).collect()
    assert {r["word"]: r["n_near"] for r in found} == {w: sum(edited(w, v) for v in words) for w in words}


def test_empty_table(spark):
    assert spelling.variants(documents(spark, [])).collect() == []
    assert rows(spelling.variants(documents(spark, ODD))) == keyed(expected(counted(ODD)))


def test_checksums_and_runs():
    texts = ["", "Éa × Bc÷d", "naïve x" * 3, "ab€́cd", "ÿÀ"]
    whole = [t.encode() for t in texts]
    part = spelling.Texts(np.frombuffer(b"".join(whole), np.uint8), np.cumsum([0, *map(len, whole)]))
    found = spelling.runs(part)
    want = [[w.translate(LOWER) for w in RUN.findall(t)] for t in texts]
    assert [[w.decode() for w in found.words(i)] for i in range(len(texts))] == want
    heads = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(texts))], np.uint32)
    flat = [zlib.crc32(f"{i}:{w}".encode()) for i, own in enumerate(want) for w in own]
    assert spelling.checksums(found, heads).tolist() == flat


def test_one_edit():
    draw = random.Random(6)
    words = ["".join(draw.choice("ab") for _ in range(draw.randrange(1, 7))) for _ in range(150)]
    some = spelling.Words(pa.array(words))
    table = some.table()
    for i, a in enumerate(words):
        assert [spelling.one_edit(a.encode(), b.encode()) for b in words] == [edited(a, b) for b in words]
        own = np.full(len(words), i)
        level = np.abs(some.sizes - len(a)) <= 1
        other = np.arange(len(words))[level]
        near = spelling._edits(table[own[level]], table[other], some.sizes[own[level]], some.sizes[other])
        assert near.tolist() == [edited(a, words[b]) for b in other]
