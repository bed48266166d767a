"""SentencePiece encoding and decoding that keep the source's byte spans.

A text is normalised by longest-prefix matches in the model's compiled character map, and
every normalised byte records the source byte it came from. The model's merges then run on
the normalised text, cut where no piece of the vocabulary can reach across, so that each
distinct word is merged once per task. Piece lengths added up give normalised offsets, and
the recorded alignment projects them to spans of source bytes.

Nulls count as empty texts, which have no piece (but the end id, if asked for). Texts of
any length are encoded whole. Rows are independent: repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from shopstar.llm.tidy import tidy

SPACE = "▁"
_SPACE_BYTES = SPACE.encode()
CACHED_WORDS = 150_000


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, message[at : at + size]
        at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and its texts."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0]
        self.units = struct.unpack_from(f"<{size // 4}I", compiled, 4)
        self.texts = compiled[4 + size :]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that starts here."""
        found, node = None, self._step(self.units[0])
        for end in range(at, len(source)):
            node ^= source[end]
            unit = self.units[node]
            if unit & 0x800000FF != source[end]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.texts[start : self.texts.index(b"\0", start)]


class Normaliser:
    """Normalised text and, for each of its bytes and its end, the source byte behind it."""

    def __init__(self, spec: bytes):
        given = dict(_fields(spec))
        self.map = CharacterMap(given[2]) if given.get(2) else None
        self.dummy_prefix = bool(given.get(3, 1))
        self.squeeze = bool(given.get(4, 1))
        self.escape = bool(given.get(5, 1))

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        source = text.encode()
        if not source:
            return "", np.zeros(1, np.int64)
        plain = self.map is None and not self.squeeze and self.escape
        return self._plain(text, source) if plain else self._mapped(source)

    def _plain(self, text: str, source: bytes) -> tuple[str, np.ndarray]:
        """Without a map only spaces change: one byte becomes three."""
        widths = np.ones(len(source), np.int64)
        widths[np.frombuffer(source, np.uint8) == 32] = len(_SPACE_BYTES)
        aligned = np.repeat(np.arange(len(source)), widths)
        lead = [0] * len(_SPACE_BYTES) if self.dummy_prefix else []
        prefix = SPACE if self.dummy_prefix else ""
        return prefix + text.replace(" ", SPACE), np.concatenate([lead, aligned, [len(source)]]).astype(np.int64)

    def _pieces(self, source: bytes) -> Iterator[tuple[int, int, bytes]]:
        at = 0
        while at < len(source):
            found = self.map.longest(source, at) if self.map else None
            if found is None:
                lead = source[at]
                width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
                found = width, source[at : at + width]
            yield at, at + found[0], found[1]
            at += found[0]

    def _mapped(self, source: bytes) -> tuple[str, np.ndarray]:
        space = _SPACE_BYTES if self.escape else b" "
        out, aligned, end = bytearray(), [], 0
        after_space, started = self.squeeze, False
        for start, stop, text in self._pieces(source):
            if after_space:
                text = text.lstrip(b" ")
            if text and not started and self.dummy_prefix:
                out += space
                aligned += [start] * len(space)
            started = started or bool(text)
            if text:
                text_end = text.endswith(b" ")
                text = text.replace(b" ", space)
                out += text
                aligned += [start] * len(text)
                after_space = self.squeeze and text_end
            if not started or not self.squeeze or not after_space:
                end = stop
        if self.squeeze:
            while out.endswith(space):
                end = aligned[len(out) - len(space)]
                del out[len(out) - len(space) :], aligned[len(out) :]
        return out.decode(), np.array([*aligned, end], np.int64)


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        fields = dict(_fields(model.serialized_model_proto()))
        trainer = dict(_fields(fields.get(2, b"")))
        self.normalise = Normaliser(fields.get(3, b""))
        # Here the text comes normalised and the model has only its merges left to do: a
        # second normaliser message, merged over the first, leaves the text as it is.
        verbatim = bytes([0x12, 0, 0x18, 0, 0x20, 0, 0x28, 0])
        message = model.serialized_model_proto() + bytes([0x1A, len(verbatim)]) + verbatim
        model = sentencepiece.SentencePieceProcessor(model_proto=message)
        ids = range(model.vocab_size())
        pieces = [model.id_to_piece(i) for i in ids]
        self.end, self.unknown = model.eos_id(), model.unk_id()
        self.byte = np.array([model.is_byte(i) for i in ids])
        self.control = np.array([model.is_control(i) for i in ids])
        surface = trainer.get(44, " ⁇ ".encode())
        shown = []
        for i, piece in enumerate(pieces):
            if self.byte[i]:
                shown.append(bytes([int(piece[3:5], 16)]))
            elif self.control[i]:
                shown.append(b"")
            else:
                shown.append(surface if i == self.unknown else piece.replace(SPACE, " ").encode())
        self.shown = shown
        self._lengths = np.array([len(x) for x in shown], np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self._lengths)[:-1]])
        self._flat = np.frombuffer(b"".join(shown), np.uint8)
        # Bytes of normalised text that a piece stands for.
        self.widths = np.array([1 if self.byte[i] else 0 if self.control[i] else len(p.encode()) for i, p in enumerate(pieces)], np.int64)
        inner = any(SPACE in p.lstrip(SPACE) for i, p in enumerate(pieces) if not (self.byte[i] or self.control[i]))
        self._cut = None if inner or not self.normalise.escape else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self._model = model
        self._cache: dict[str, tuple[bytes, bytes]] = {}

    def ids(self, normalised: str) -> tuple[bytes, np.ndarray]:
        """Ids of a normalised text, as decimal text joined by spaces and as numbers."""
        if not normalised:
            return b"", np.zeros(0, np.int32)
        words = self._cut.findall(normalised) if self._cut else [normalised]
        known = self._cache
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > CACHED_WORDS:
                known.clear()
                new = list(set(words))
            self._merge(new)
        both = [known[w] for w in words]
        return b" ".join([x[0] for x in both]), np.frombuffer(b"".join([x[1] for x in both]), np.int32)

    def _merge(self, words: list[str]) -> None:
        """Learn the ids of new words: one call for all, cut again at the words' ends."""
        joined = [w for w in words if w.startswith(SPACE) and not w.endswith(SPACE)]
        found = self._model.encode("".join(joined))
        numbers = np.array(found, np.int32)
        ends = np.cumsum([len(w.encode()) for w in joined], dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(self.widths[numbers]), ends, side="right").tolist()
        raw, begin = numbers.tobytes(), 0
        for word, end in zip(joined, cuts):
            self._cache[word] = " ".join(map(str, found[begin:end])).encode(), raw[4 * begin : 4 * end]
            begin = end
        for word in words:
            if not word.startswith(SPACE) or word.endswith(SPACE):
                alone = self._model.encode(word)
                self._cache[word] = " ".join(map(str, alone)).encode(), np.array(alone, np.int32).tobytes()

    def forget(self) -> None:
        """Drop the words met so far."""
        self._cache.clear()

    def spans(self, ids: np.ndarray, aligned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each piece in the bytes of the source."""
        widths = self.widths[ids]
        if self.unknown >= 0 and (ids == self.unknown).any():
            raise ValueError("spans need a model with byte fallback or full coverage")
        ends = np.cumsum(widths)
        return aligned[ends - widths], aligned[ends]

    def decode(self, ids: np.ndarray) -> str:
        """Text of any ids, as the library decodes them."""
        kept = ids[~self.control[ids]] if self.control[ids].any() else ids
        if not len(kept):
            return ""
        lengths = self._lengths[kept]
        ends = np.cumsum(lengths)
        spread = np.repeat(self._starts[kept] - (ends - lengths), lengths)
        raw = self._flat[spread + np.arange(len(spread))].tobytes()
        first, last = (int(x) for x in np.flatnonzero(~self.control[ids])[[0, -1]])
        try:
            text = self._broken(ids) if last - first >= len(kept) else raw.decode()
        except UnicodeDecodeError:
            text = self._broken(ids)
        lead = self.normalise.dummy_prefix or self.normalise.squeeze
        if lead and not self.byte[kept[0]] and kept[0] != self.unknown and text.startswith(" "):
            text = text.lstrip(" ") if self.normalise.squeeze else text[1:]
        return text

    def _broken(self, ids: np.ndarray) -> str:
        """Byte pieces run by run, as other pieces part them; each odd byte shows as U+FFFD."""
        out, run = [], bytearray()

        def close():
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + width].decode())
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids.tolist():
            if self.byte[i]:
                run.extend(self.shown[i])
            else:
                close()
                out.append(self.shown[i].decode())
        close()
        return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every text with their spans in the text's UTF-8 bytes.

    Returns the key, ids, and the arrays starts and ends. A null text has no piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            ids, starts, ends = [], [], []
            for value in batch.column(1).to_pylist():
                normal, aligned = own.normalise(value or "")
                found = own.ids(normal)[1]
                a, b = own.spans(found, aligned)
                ids.append(found)
                starts.append(a)
                ends.append(b)
            arrays = [pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["_key", "ids", "starts", "ends"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    shape = f"_key {kind}, ids array<int>, starts array<bigint>, ends array<bigint>"
    return rows.mapInArrow(run, shape).withColumnRenamed("_key", key)


def decode(encoded: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Text of every list of ids; a null list gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            texts = [own.decode(np.array(x or [], np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_key", "text"])

    kind = dict(encoded.dtypes)[key]
    rows = encoded.select(encoded[key].alias("_key"), encoded[ids].alias("_ids"))
    return rows.mapInArrow(run, f"_key {kind}, text string").withColumnRenamed("_key", key)


def digests(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of the ids (with the end id) and of the decoded text, in one pass.

    Returns the key, n_tokens, ids_sha256, decoded_sha256, n_bytes of the text and
    span_bytes, the bytes that the pieces' spans cover: equal where the source is whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        last = str(own.end).encode()
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                value = value or ""
                normal, aligned = own.normalise(value)
                spelled, ids = own.ids(normal)
                starts, ends = own.spans(ids, aligned)
                shown = own.decode(np.append(ids, np.int32(own.end)))
                rows.append(
                    (
                        len(ids) + 1,
                        hashlib.sha256(spelled + b" " + last if len(ids) else last).hexdigest(),
                        hashlib.sha256(shown.encode()).hexdigest(),
                        int(aligned[-1]),
                        int((ends - starts).sum()),
                    )
                )
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["_key", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "span_bytes"])
        own.forget()

    kind = dict(docs.dtypes)[key]
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    shape = f"_key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint, span_bytes bigint"
    return rows.mapInArrow(tidy(run), shape).withColumnRenamed("_key", key)
