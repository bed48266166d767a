"""The registered query of each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.llm import (
    decontam,
    jaccard,
    langid,
    lm,
    maxscore,
    mixing,
    pieces,
    spelling,
    substring,
    survival,
    toxicity,
    vptree,
    warc,
)
from shopstar.llm.oracle import ORACLE
from shopstar.llm.ship import ship
from shopstar.session import bytes_under, size_shuffles

TOXIC = 0.7
# Recall against brute force is measured in tests/llm/test_search.py.
RELAX = 1.5
MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    ship(spark)
    size_shuffles(spark, bytes_under(spark, path))
    return spark.read.parquet(path)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op2_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs, langid.fold(4) != 2)
    found = langid.predict(docs, model)
    return found.withColumn("held_out", F.coalesce(langid.fold(4) == 2, F.lit(False)))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.fit(docs, _table(spark, folder, "labels"), langid.fold(3) != 1)
    found = toxicity.predict(docs, model)
    held_out = F.coalesce(langid.fold(3) == 1, F.lit(False))
    predicted = (F.col("score") >= TOXIC).cast("int")
    return found.withColumns({"held_out": held_out, "predicted": predicted})


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write_archives(_table(spark, folder, "pages"), warc.archive_folder(spark))
    return warc.read_archives(manifest).drop("payload")


def op5_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.search(_table(spark, folder, "embeddings"), F.col("id") % 100 == 0, k=10)


def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, folder, "documents"))


def op7_substring(spark: SparkSession, folder: str) -> DataFrame:
    return substring.digests(_table(spark, folder, "documents"))


def op8_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return lm.score(docs, lm.fit(docs))


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(_table(spark, folder, "documents"), model_path())


def op10_vptree(spark: SparkSession, folder: str) -> DataFrame:
    return vptree.search(_table(spark, folder, "embeddings"), F.col("id") % 50 == 0, k=5, relax=RELAX)


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return decontam.digests(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return survival.audit(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_langid": op2_langid,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_maxscore": op5_maxscore,
    "op6_jaccard": op6_jaccard,
    "op7_substring": op7_substring,
    "op8_lm": op8_lm,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_vptree": op10_vptree,
    "op11_decontamination": op11_decontamination,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling": op13_spelling,
}
