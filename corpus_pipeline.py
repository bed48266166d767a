"""Corpus preparation: language, near copies, repeated passages, source mix, token ids.

Every stage reads what the stage before it wrote and returns the columns of documents, with
further ones, whatever their names, as they came; the last returns what a trainer stores of
each text: the digests of its ids and their decoding. Texts of any length count whole, an
empty table stays empty, and each stage's docstring says what becomes of rows without a text,
without an id, or of an id that others have too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstar.llm import jaccard, langid, mixing, pieces, substring
from shopstar.llm.queries import model_path
from shopstar.llm.ship import ship
from shopstar.sources.scratch import Scratch, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go.

    Each row is judged by its text alone, whatever its id. Rows without a text, or with no
    letter in it, go. Only rows with id, text and language are learnt from; with none of them
    every row goes.
    """
    ship(spark)
    return langid.accepted(docs, langid.fit(docs, langid.fold(4) != 2))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id.

    A row without an id, or of an id that others have too, stays only if no row with an id of
    its own is in its component; of rows alike in id and text one stays. Rows without a word
    are no copies of anything: all stay, but for those of one id.
    """
    ship(spark)
    return jaccard.distinct_documents(docs)


def passages_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words and more that occur elsewhere.

    Every row is a place of its own: also of two rows alike in id and text both lose what they
    share. A text that loses nothing, or is null, stays as it is, spaces included.
    """
    ship(spark)
    return substring.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice.

    Rows go by id and text, also if ids repeat or are null; rows without a word are not taken.
    A null source is a source of its own.
    """
    return mixing.mixed_documents(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the token ids, and digest of the decoded text.

    A row for each row, whatever its id; a null text is an empty one, with the end id alone.
    """
    ship(spark)
    return pieces.digests(docs, model_path())


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("repeated_passages", passages_once),
    ("source_mix", mixed),
    ("sentencepiece", tokenised),
]
# Trained models and merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.keep(stage(spark, docs, sf_dir))
        return stored(STAGES[-1][1](spark, docs, sf_dir))
