"""The pipeline and its stages on odd rows, an empty table and clashing column names."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from shopstar.llm import langid, mixing
from shopstar.llm.queries import model_path
from tests.llm import test_jaccard, test_substring
from tests.llm.rows import EXTRA, ODD, documents, words
from tests.llm.test_models import prose

STAGES = dict(corpus_pipeline.STAGES)
SHARED = " ".join(f"p{i}" for i in range(60))
ROWS = [
    *prose(120),
    *[(1000 + r[0] if r[0] is not None else None, *r[1:]) for r in ODD],
    # One text under an id of its own, twice under one id, and twice without an id.
    (2000, "copy " + SHARED, "aa", "s", 1),
    (2001, "copy " + SHARED, "aa", "t", 1),
    (2001, "copy " + SHARED, "aa", "t", 1),
    (None, "copy " + SHARED, "bb", None, 1),
    (None, "copy " + SHARED, "bb", None, 1),
    # Two texts under one id, and a passage in another text.
    (2002, "one text about nothing much at all here", "aa", "s", 1),
    (2002, "another text under the same old number", "aa", "s", 1),
    (2003, "before " * 3 + SHARED + " after" * 40, "aa", None, 1),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("pipeline"))
    documents(spark, ROWS, extra=True).write.parquet(f"{base}/odd/documents.parquet")
    documents(spark, [], extra=True).write.parquet(f"{base}/empty/documents.parquet")
    return base


def plain(frame):
    return [tuple(r) for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def test_stages_on_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/odd/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, f"{folder}/odd")
        assert out.columns == docs.columns and set(EXTRA) <= set(out.columns), name
        assert Counter(plain(out)).keys() <= Counter(plain(docs)).keys() or name == "repeated_passages"


def test_language_goes_by_the_text_alone(spark, folder):
    docs = spark.read.parquet(f"{folder}/odd/documents.parquet")
    model = langid.fit(docs, langid.fold(4) != 2)
    names, _, rejected = langid.judge(__import__("pyarrow").array([r[1] for r in plain(docs)]), model)
    want = [r for r, gone in zip(plain(docs), rejected) if not gone]
    assert same(plain(STAGES["language_id"](spark, docs, folder)), want)
    assert all(gone for r, gone in zip(plain(docs), rejected) if not any(c.isalpha() for c in r[1] or ""))
    assert len(names) == len(ROWS)


def test_one_of_each_component(spark, folder):
    docs = spark.read.parquet(f"{folder}/odd/documents.parquet")
    out = plain(STAGES["near_duplicates"](spark, docs, folder))
    copies = [r for r in out if r[1] == "copy " + SHARED]
    assert [r[0] for r in copies] == [2000]
    assert sum(r[0] == 2002 for r in out) == 2
    lone = {i for i, _, c in test_jaccard.expected([r for r in ROWS if r[0] is not None]) if i == c}
    assert lone - {2001} <= {r[0] for r in out} | {1006}


def test_passages_go_from_every_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/odd/documents.parquet")
    rows = plain(docs)
    want = []
    for row, own, left in zip(rows, *test_substring.kept(rows, 35)):
        joined = " ".join(left)
        want.append(row if len(own) == len(left) else (row[0], joined, *row[2:4], len(joined)))
    assert same(plain(STAGES["repeated_passages"](spark, docs, folder)), want)


def test_mix_takes_rows_by_id_and_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/odd/documents.parquet")
    out = Counter(r[:2] for r in plain(STAGES["source_mix"](spark, docs, folder)))
    assert all(words(text) for _, text in out)
    took = {(r["doc_id"], r["place"]): r for r in mixing.mix(docs).collect()}
    marked = docs.withColumn("at", mixing._place(mixing.SEED)).collect()
    alike = Counter((r["doc_id"], r["text"]) for r in marked)
    for r in marked:
        found = took[r["doc_id"], r["at"]]
        share = found["taken"] / found["size"] if found["size"] else 0
        if alike[r["doc_id"], r["text"]] == 1:
            assert abs(out[r["doc_id"], r["text"]] - share) <= 0.5


def test_ids_of_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/odd/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    want = Counter()
    for i, text, *_ in ROWS:
        ids = [*library.encode(text or ""), library.eos_id()]
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()] += 1
    out = STAGES["sentencepiece"](spark, docs, folder)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in out.collect()) == want


def test_whole_run_on_odd_rows_and_no_rows(spark, folder):
    out = corpus_pipeline.run(spark, f"{folder}/odd").collect()
    ids = Counter(r["doc_id"] for r in out)
    assert ids and all(n >= 1 for n in ids.values())
    assert 2001 not in ids
    assert corpus_pipeline.run(spark, f"{folder}/empty").collect() == []
    docs = spark.read.parquet(f"{folder}/empty/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, f"{folder}/empty").count() == 0, name
