from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from shopstar.llm import pieces
from shopstar.llm.queries import model_path
from tests.llm.rows import ODD, documents

SIGNS = [*" \t\n▁  aaabbcethXY", "é", "ü", "字", "\U0001f600", "\x00", " <0x41>", "</s>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def test_ids_spans_and_decoding_of_any_text(library):
    own, draw = pieces.Codec(model_path()), random.Random(1)
    texts = ["".join(draw.choices(SIGNS, k=draw.randint(0, 40))) for _ in range(1500)]
    for text in [*texts, "word " * 500, "x" * 5000, " ", "", "▁▁"]:
        normal, aligned = own.normalise(text)
        spelled, ids = own.ids(normal)
        assert ids.tolist() == library.encode(text)
        assert spelled.decode().split() == [str(i) for i in ids]
        assert own.decode(ids) == library.decode(ids.tolist())
        starts, ends = own.spans(ids, aligned)
        assert starts[1:].tolist() == ends[:-1].tolist()
        assert not len(ids) or (starts[0] == 0 and ends[-1] == len(text.encode()))


def test_decoding_of_any_ids(library):
    own, draw = pieces.Codec(model_path()), random.Random(2)
    some = [0, 1, 2, 3, 4, 150, 180, 200, 230, 259, 500, 13000, 28705]
    for _ in range(1500):
        ids = draw.choices(some, k=draw.randint(0, 8))
        assert own.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_character_map_replaces_longest_prefixes():
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = rule.serialized_normalizer_spec
    own = pieces.Normaliser(spec() if callable(spec) else spec)
    draw, signs = random.Random(3), [*"  \tab", "Ａ", "①", "ﬁ", "é", "ｶﾞ", "​", "　", "Ⅳ"]
    for _ in range(1500):
        text = "".join(draw.choices(signs, k=draw.randint(0, 12)))
        normal, offsets = rule.normalize(text, with_offsets=True)
        ours, aligned = own(text)
        assert ours == normal
        if normal:
            at = np.cumsum([0, *(len(c.encode()) for c in ours)])
            assert [len(text.encode()[: aligned[i]].decode()) for i in at] == list(offsets)


def test_tables(spark, library):
    docs = documents(spark, extra=True)
    got = sorted((tuple(r)[:4] for r in pieces.digests(docs, model_path()).collect()), key=repr)
    want = []
    for doc_id, text, *_ in ODD:
        ids = [*library.encode(text or ""), library.eos_id()]
        spelled = " ".join(map(str, ids)).encode()
        shown = library.decode(ids).encode()
        want.append((doc_id, len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(shown).hexdigest()))
    assert got == sorted(want, key=repr)
    encoded = pieces.encode(docs, model_path())
    shown = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, model_path()).collect()}
    # A space sign in the text itself decodes as a space, as in the library.
    assert shown == {doc_id: (text or "").replace("▁", " ") for doc_id, text, *_ in ODD}
    for row in encoded.filter("doc_id = 7").collect():
        raw = ODD[8][1].encode()
        assert b"".join(raw[a:b] for a, b in zip(row["starts"], row["ends"])) == raw


def test_no_rows(spark):
    none = documents(spark, [])
    assert pieces.digests(none, model_path()).count() == 0
    assert pieces.encode(none, model_path()).count() == 0
