from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopstar.llm import jaccard, links
from shopstar.sources.scratch import Scratch
from tests.llm.rows import LOWER, ODD, documents, words


def shingles(text, size=5):
    own = words((text or "").translate(LOWER))
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def expected(rows, percent=75):
    """doc_id -> (size, component) by comparing every pair."""
    sets = {}
    for i, text, *_ in rows:
        sets.setdefault(i, []).append(shingles(text))
    lead = {i: i for i in sets if i is not None}

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    ids = sorted(lead)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((top(a), top(b)))
                lead[y] = x
    return sorted(((i, len(shingles(t)), None if i is None else top(i)) for i, t, *_ in rows), key=repr)


def found(spark, rows, **options):
    out = jaccard.near_duplicates(documents(spark, rows, extra=True), **options).collect()
    return sorted((tuple(r) for r in out), key=repr)


def varied(seed, n=160):
    """Texts of a few bases with edits around the threshold, and a passage many share."""
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    bases = [[f"w{draw.randint(0, 400)}" for _ in range(draw.choice([3, 5, 20, 60, 120]))] for _ in range(12)]
    rows = []
    for i in range(n):
        own = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 2, 4, 9])):
            at = draw.randrange(len(own))
            own[at : at + draw.choice([0, 1])] = [f"e{draw.randint(0, 50)}"]
        if draw.random() < 0.4:
            own += passage
        text = " ".join(w.upper() if draw.random() < 0.1 else w for w in own)
        rows.append((i, text, "en", "s", 1))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_those_of_all_pairs(spark, seed):
    rows = varied(seed)
    assert found(spark, rows) == expected(rows)


def test_other_threshold(spark):
    rows = varied(3, 80)
    assert found(spark, rows, percent=50) == expected(rows, 50)


def test_odd_rows(spark):
    assert found(spark, ODD) == expected(ODD)
    assert found(spark, []) == []


def test_chain_needs_later_rounds(spark):
    """Neighbours of a drifting text are similar, its ends are not: a list's first member
    does not link to the last, and only later rounds compare the rest."""
    stream = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(stream[7 * i : 7 * i + 100]), "en", "s", 1) for i in range(40)]
    random.Random(5).shuffle(rows)
    assert found(spark, rows) == expected(rows)
    assert len({c for _, _, c in expected(rows)}) == 1


def test_equal_prefixes_and_sizes_are_expanded(spark):
    """With nothing rare about them, texts may agree in their prefix alone."""
    rows = [(i, " ".join(f"w{j}" for j in range(30)) + f" x{i}", "en", "s", 1) for i in range(30)]
    assert found(spark, rows) == expected(rows)


def test_components_of_links(spark):
    rows = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (500, 400), (500, 400)]
    with Scratch(spark) as scratch:
        out = links.components(spark.createDataFrame(rows, "x bigint, y bigint"), scratch).collect()
    got = {r["node"]: r["component"] for r in out}
    assert len(out) == len(got)
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}, 400: 400, 500: 400}


def test_ids_beyond_the_broadcast_bound_are_joined(spark, monkeypatch):
    rows, ids = spark.range(10).toDF("k"), spark.range(3).toDF("x")
    for bound in (1 << 20, 1):
        monkeypatch.setattr(links, "BROADCAST_IDS", bound)
        assert links.picked(rows, "k", ids).count() == 3
        assert links.picked(rows, "k", ids, without=True).count() == 7


def test_one_document_of_each(spark):
    rows = varied(4, 60) + [(None, "lone", None, None, None)]
    docs = documents(spark, rows, extra=True)
    kept = jaccard.distinct_documents(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in expected(rows) if i == c}
    assert {r["doc_id"] for r in kept.select(F.col("doc_id")).collect()} == want | {None}


def test_one_row_of_each_with_repeated_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text.replace("w59", "x"), " ".join(f"v{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, near), (None, other), (None, other), (5, other + " y")]
    rows += [(6, "alone as it is"), (6, "alone as it is"), (7, "one text of two"), (7, "the other of the two texts")]
    rows += [(None, None), (None, ""), (None, " "), (8, None), (8, ""), (9, "short"), (None, "short")]
    docs = documents(spark, [(*r, "en", "s", 1) for r in rows], extra=True)
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard.distinct_documents(docs).collect()), key=repr)
    want = [(2, text), (5, other + " y"), (6, "alone as it is"), (7, "one text of two"), (7, "the other of the two texts")]
    want += [(None, None), (None, ""), (None, " "), (8, None), (8, ""), (9, "short")]
    assert kept == sorted(want, key=repr)
    assert jaccard.distinct_documents(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        jaccard.distinct_documents(documents(spark, [(jaccard.SUBSTITUTES, "a", "en", "s", 1)]))


def test_groups_are_entries_and_large_ones_several(spark):
    """A list has one entry for a group, and no entry stands for many members."""
    rows = [(i, 5 if i < 3 else 6, bytes([i % 2] if i < 3 else [9])) for i in range(100)]
    heads = spark.createDataFrame(rows, "id bigint, n bigint, alike binary")
    with Scratch(spark) as scratch:
        members = jaccard._grouped(heads, scratch).collect()
    assert {r["m"] for r in members} == {0, 2, *range(3, 100)}
    assert {r["g"] for r in members if r["m"] < 3} == {0}
    sizes = Counter(r["g"] for r in members if r["m"] >= 3)
    assert len(sizes) == 13 and max(sizes.values()) <= 4 * jaccard.MEMBERS
    assert all(r["g"] == min(x["m"] for x in members if x["g"] == r["g"]) for r in members)


def test_crowded_groups_that_are_similar_in_part(spark):
    """Two groups of many members each, some pairs of which are similar across."""
    draw = random.Random(8)
    a, b = [f"p{i}" for i in range(26)], [f"p{i}" for i in range(20)] + [f"q{i}" for i in range(6)]
    core = [f"k{i}" for i in range(150)]
    rows = [(2 * i, " ".join(a + draw.sample(core, 74)), "en", "s", 1) for i in range(40)]
    rows += [(2 * i + 1, " ".join(b + draw.sample(core[:90], 74)), "en", "s", 1) for i in range(40)]
    rows += [(1000 + i, " ".join(core + [f"u{j}" for j in range(300)]), "en", "s", 1) for i in range(90)]
    got = {i: c for i, _, c in found(spark, rows, size=1, percent=60)}
    sets = {i: frozenset(t.split()) for i, t, *_ in rows}
    linked = {i: i for i in sets}

    def root(i):
        while linked[i] != i:
            i = linked[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j]):
                x, y = sorted((root(i), root(j)))
                linked[y] = x
    assert got == {i: root(i) for i in sets}
    assert 3 <= len(set(got.values())) <= 60


def test_texts_of_equal_prefix_and_size_are_judged_one_by_one(spark):
    """Texts 2 and 3 agree in prefix and size but are not similar: that 1, 2 and 4 are one
    component does not spare 3, which is similar to 4 alone, the comparison with it."""
    prefix = [f"p{i}" for i in range(26)]
    core, x, y = ([f"{k}{i}" for i in range(n)] for k, n in (("k", 58), ("x", 16), ("y", 16)))
    sets = [prefix + core + x + ["c"], prefix + core + x, prefix + core + y, prefix + core + x[:8] + y[:8] + ["b1", "b2"]]
    assert [len(s) for s in sets] == [101, 100, 100, 102]
    # These make all but the prefix frequent, and are similar to none of the four.
    usual = core + x + y + ["c", "b1", "b2"] + [f"u{i}" for i in range(300)]
    rows = [(i, " ".join(s), "en", "s", 1) for i, s in enumerate(sets + [usual] * 9, 1)]
    component = {i: c for i, _, c in found(spark, rows, size=1)}
    assert component == {1: 1, 2: 1, 3: 1, 4: 1} | {i: 5 for i in range(5, 14)}


def test_near_copies_of_equal_prefix_are_not_all_paired(spark, monkeypatch):
    prefix, core, own = ([f"{k}{i}" for i in range(n)] for k, n in (("p", 26), ("k", 73), ("x", 30)))
    usual = core + own + [f"u{i}" for i in range(300)]
    rows = [(i, " ".join(prefix + core + [x]), "en", "s", 1) for i, x in enumerate(own, 1)]
    rows += [(i, " ".join(usual), "en", "s", 1) for i in range(31, 71)]
    compared, plausible = [], jaccard._plausible
    monkeypatch.setattr(jaccard, "_plausible", lambda pairs, *rest: compared.append(pairs.count()) or plausible(pairs, *rest))
    component = {i: c for i, _, c in found(spark, rows, size=1)}
    assert component == {i: 1 if i < 31 else 31 for i in range(1, 71)}
    assert sum(compared) == 29
