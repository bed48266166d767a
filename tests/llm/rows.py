"""Small tables with the odd rows that every operator must bear."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names operators might use themselves.
EXTRA = ["id", "h", "g", "token", "rank", "place", "score", "size", "target", "component", "words", "spans", "_key", "_text", "n", "part"]
ODD = [
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, " \n\t", None, "b", 3),
    (4, "One", "en", "b", 3),
    (5, "one two", "de", "c", 7),
    (6, "one two", "de", "c", 7),
    (6, "one two", "de", "c", 7),
    (None, "no id at all but some words", None, None, None),
    (7, "été ▁ \U0001f600 \x00 <s> 5%", "fr", "é", 20),
    (8, "word " * 3000, "en", "a", 15000),
    (9, "x" * 20000, "en", "a", 20000),
]


def documents(spark, rows=None, extra: bool = False):
    frame = spark.createDataFrame(ODD if rows is None else rows, DOCUMENTS)
    for name in EXTRA if extra else ():
        frame = frame.withColumn(name, frame["n_chars"])
    return frame


def words(text):
    return WORD.findall(text or "")


def keyed(rows):
    return sorted(rows, key=repr)
