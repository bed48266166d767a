"""The registered queries over the given tables, and the pipeline against plain Python."""

from __future__ import annotations

import glob
import hashlib
import os
from collections import Counter

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from shopstar.llm import langid, mixing
from shopstar.llm.queries import ORACLE, QUERIES, model_path
from tests.llm import test_jaccard, test_substring
from tests.llm.rows import words
from tests.llm.test_mixing import goals

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
COLUMNS = {
    "op1": ["doc_id", "size", "source_size", "target", "taken"],
    "op2": ["doc_id", "held_out", "lang_pred", "score"],
    "op3": ["doc_id", "held_out", "score", "predicted"],
    "op4": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5": ["query_id", "rank", "vec_id", "score"],
    "op6": ["doc_id", "n_shingles", "component_id"],
    "op7": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op8": ["doc_id", "n_tokens", "log_likelihood"],
    "op9": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10": ["query_id", "rank", "vec_id", "score"],
    "op11": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op12": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op13": ["word", "form", "root", "n", "n_near", "form_n"],
}


def small():
    if not os.path.isdir(SMALL):
        pytest.skip(f"no tables under {SMALL}")
    return SMALL


def test_one_query_for_each_operator():
    assert sorted(k.split("_")[0] for k in QUERIES) == sorted(COLUMNS)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("key", list(QUERIES))
def test_columns(spark, key):
    out = QUERIES[key](spark, small())
    assert set(COLUMNS[key.split("_")[0]]) <= set(out.columns)
    table = {"op4": "pages", "op5": None, "op10": None, "op12": None, "op13": None}.get(key.split("_")[0], "documents")
    if table:
        assert out.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("key", list(ORACLE))
def test_query_equals_sql(spark, sf_dir, key):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(ORACLE[key])
    names = [d[0] for d in found.description]
    out = QUERIES[key](spark, sf_dir)
    assert sorted(out.columns) == sorted(names)
    assert Counter(tuple(r) for r in out.select(*names).collect()) == Counter(found.fetchall())


def test_mix_reaches_its_targets(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    want, taken = goals(sizes), Counter()
    for r in QUERIES["op1_mixing"](spark, sf_dir).collect():
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == pytest.approx(want[s], rel=0.02) for s in sizes)


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op2_langid"](spark, sf_dir).filter("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_toxicity_of_held_out_documents(spark):
    if not os.path.isdir(LARGE):
        pytest.skip(f"no tables under {LARGE}")
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op3_toxicity"](spark, LARGE).filter("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.5 * len(toxic)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.01 * len(rows)


def test_tokens_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small()}/documents.parquet").collect()}
    for r in QUERIES["op9_sentencepiece"](spark, SMALL).collect():
        ids = [*library.encode(texts[r["doc_id"]] or ""), library.eos_id()]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r["span_bytes"] == r["n_bytes"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{small()}/documents.parquet")
    language, copies, passages, mix, tokens = [stage for _, stage in corpus_pipeline.STAGES]
    plain = lambda frame: [tuple(r) for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows = {r[0]: r for r in plain(docs)}

    one = language(spark, docs, SMALL)
    assert one.columns == docs.columns
    model = langid.fit(docs, langid.fold(4) != 2)
    rejected = {r["doc_id"] for r in langid.predict(docs, model).filter("rejected").collect()}
    kept = {i: r for i, r in rows.items() if i not in rejected}
    assert sorted(plain(one)) == sorted(kept.values())
    assert len(kept) >= 0.98 * len(rows)

    two = copies(spark, one, SMALL)
    firsts = {i for i, _, c in test_jaccard.expected(list(kept.values())) if i == c}
    kept = {i: r for i, r in kept.items() if i in firsts}
    assert sorted(plain(two)) == sorted(kept.values())

    three = passages(spark, two, SMALL)
    for (i, text, *rest), own, left in zip(list(kept.values()), *test_substring.kept(list(kept.values()), 35)):
        if len(own) != len(left):
            kept[i] = (i, " ".join(left), *rest[:-1], len(" ".join(left)))
    assert sorted(plain(three)) == sorted(kept.values())

    three = spark.createDataFrame(plain(three), docs.schema)
    four = mix(spark, three, SMALL)
    times = Counter(r[0] for r in plain(four))
    for r in mixing.mix(three).collect():
        share = r["taken"] / r["size"] if r["size"] else 0
        assert abs(times[r["doc_id"]] - share) <= 0.5
    assert set(times.values()) <= {1, 2}

    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    want = Counter()
    for i, n in times.items():
        ids = [*library.encode(kept[i][1]), library.eos_id()]
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()] += n
    assert Counter(tuple(r)[:3] for r in tokens(spark, four, SMALL).collect()) == want
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() == sum(want.values())
    assert out.select(F.countDistinct("doc_id")).first()[0] == len(want)
