from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from shopstar.llm import mixing
from tests.llm.rows import ODD, documents, words


def fair(seats, parties):
    """Seats one by one to the highest quotient; parties: (name, weight, cap) in order."""
    own = {name: 0 for name, _, _ in parties}
    for _ in range(seats):
        able = [(Fraction(w, 2 * own[n] + 1), -i, n) for i, (n, w, c) in enumerate(parties) if w and own[n] < c]
        if able:
            own[max(able)[2]] += 1
    return own


@pytest.mark.parametrize("seed", range(4))
def test_seats_by_highest_quotients(spark, seed):
    draw = random.Random(seed)
    parties = [(g, i, draw.choice([0, 1, 5, 5, 40, 300]), 10**9) for g in range(6) for i in range(draw.randint(1, 9))]
    seats = {g: draw.choice([0, 1, 7, 100]) for g in range(6)}
    rows = [(g, i, w, seats[g], c) for g, i, w, c in parties]
    frame = spark.createDataFrame(rows, "g int, i int, w bigint, seats bigint, cap bigint")
    got = mixing.apportion(frame, ["g"], [F.asc("i")], "w", "seats", "cap").collect()
    assert len(got) == len(rows)
    for g in range(6):
        want = fair(seats[g], [(i, w, c) for h, i, w, c in parties if h == g])
        assert {r["i"]: r["quota"] for r in got if r["g"] == g} == want


def goals(sizes, share=1.5, most=2):
    """Targets by dealing again what the capped sources leave, until none is above."""
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        each = left / sum(weight[s] for s in free)
        above = [s for s in free if each * weight[s] > most * sizes[s]]
        for s in above or free:
            target[s] = float(most * sizes[s]) if above else each * weight[s]
        free -= set(above or free)
        left = share * sum(sizes.values()) - sum(target.values())
    return target


def checked(spark, rows, near=0.02):
    docs = documents(spark, rows, extra=True)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size, sizes, taken = {}, {}, {}
    for i, text, _, source, _ in rows:
        size[i] = len(words(text))
        sizes[source] = sizes.get(source, 0) + size[i]
    want = goals(sizes)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2, near * want[s])
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=repr)
    return got


def test_mix_of_uneven_sources(spark):
    draw = random.Random(1)
    rows = []
    for i in range(600):
        source = draw.choice(["a"] * 6 + ["b", "é", "z", None])
        rows.append((i, "w " * draw.choice([0, 1, 5, 50, 400]), "en", source, 1))
    got = checked(spark, rows)
    assert sum(r["taken"] not in (0, r["size"], 2 * r["size"]) for r in got) < 40


def test_many_shards(spark):
    rows = [(i, "w " * (i % 90), "en", "abc"[i % 3], 1) for i in range(500)]
    sizes = mixing.mix(documents(spark, rows), shard_words=500, block_words=16).groupBy("source", "shard").count()
    assert sizes.count() > 30
    checked(spark, rows)


def test_odd_rows(spark):
    checked(spark, ODD)
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0
    empty = [(1, None, None, None, None), (2, "", "en", "a", 0)]
    assert {r["taken"] for r in mixing.mix(documents(spark, empty)).collect()} == {0}


def test_documents_as_often_as_taken(spark):
    rows = [(i, "w " * (1 + i % 40), "en", "abcd"[i % 4], i) for i in range(200)]
    docs = documents(spark, rows, extra=True)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    times = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    for r in mixing.mix(docs).collect():
        assert abs(times.get(r["doc_id"], 0) - r["taken"] / r["size"]) <= 0.5


def test_no_python_in_the_plan(spark, capsys):
    sized = documents(spark).select(mixing.size_of("text"))
    sized.explain()
    assert "Python" not in capsys.readouterr().out
