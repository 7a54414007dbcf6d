"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

Texts are cut into marked words (a run of word marks and what follows it). A batch's distinct words
are sorted, which walks their trie depth-first: each word keeps the forward state of the prefix that
it shares with the word before and computes only the rest. For a unigram model the state at a place
is the best score and the piece that ends there. A BPE model's result is the one path whose
neighbouring pieces merge into nothing else, so there the state is the last piece of the prefix's
encoding, and a step is allowed only between compatible pieces.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text as tx
from ._store import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Words and piece pairs that a worker remembers; what comes later is worked out again, which costs time and changes no result.
REMEMBERED = 200_000
#: Characters of the longest word that is remembered; texts without spaces are one word each.
LONGEST_REMEMBERED = 128


def _fields(data: bytes) -> Iterable[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = struct.unpack("<f" if size == 4 else "<d", data[at : at + size])[0], at + size
        yield key >> 3, value


class Model:
    """A SentencePiece model file's pieces, scores and switches."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.types = [], [], []
        kind, norm = 1, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(piece.get(2, 0.0))
                self.types.append(piece.get(3, NORMAL))
            elif field == 2:
                kind = dict(_fields(value)).get(3, 1)
            elif field == 3:
                norm = dict(_fields(value))
        if kind not in (1, 2) or norm.get(2) or norm.get(4, 1) or not norm.get(5, 1):
            raise ValueError("only unigram and BPE models that keep text as it is (identity normaliser, white space kept and escaped)")
        self.bpe, self.prefix = kind == 2, bool(norm.get(3, 1))
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}
        self.unknown = self.types.index(UNKNOWN)
        self.longest = max(map(len, self.ids), default=1)
        # Words can be cut before a mark only if no piece holds one after another character.
        self.cut = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.floor = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0


class Encoder:
    """Words to ids, with what a task remembers."""

    def __init__(self, model: Model):
        self.model, self.words, self.fits, self.known_fits = model, {}, {}, 0
        self.suffixes = {p[i:] for p in model.ids for i in range(len(p))}
        self.raw = {p: np.array([i], np.int32).tobytes() for p, i in model.ids.items()}

    def _merge(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best-scored neighbours merge first, the left ones at a tie."""
        ids, scores, parts = self.model.ids, self.model.scores, list(text)
        while len(parts) > 1:
            best, where = None, 0
            for i in range(len(parts) - 1):
                k = ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or scores[k] > best):
                    best, where = scores[k], i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _fit(self, left: str, piece: str, of_piece: dict) -> bool:
        """Whether the two stay as they are when they meet (left empty: whether the piece is ever made)."""
        if self.known_fits > REMEMBERED:
            self.fits.clear()
            self.known_fits = 0
        self.known_fits += 1
        found = of_piece[left] = self._merge(left + piece) == ([left, piece] if left else [piece])
        return found

    def _unknown(self, char: str) -> bytes:
        m = self.model
        return np.array([m.bytes[b] for b in char.encode()] if m.bytes else [m.unknown], np.int32).tobytes()

    def encode_words(self, words: Iterable[str]) -> None:
        """Remember the ids of words, visiting them in sorted order with one shared forward state."""
        m, raw, suffixes, fits, bpe = self.model, self.raw, self.suffixes, self.fits, self.model.bpe
        last, score = [""], [0.0]  # at each place: the piece that ends there and its score
        before = ""
        for word in sorted(words):
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1 :], score[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                choice, best = "", float("-inf")
                start = end - 1
                while start >= 0:
                    piece = word[start:end]
                    known = piece in raw
                    if not known and start < end - 1 and piece not in suffixes:
                        break
                    if known or start == end - 1:
                        if bpe:
                            of_piece = fits.get(piece)
                            if of_piece is None:
                                of_piece = fits[piece] = {}
                            left = last[start]
                            ok = of_piece.get(left)
                            if ok is None:
                                ok = self._fit(left, piece, of_piece)
                            if ok:
                                choice = piece
                                break
                        else:
                            s = score[start] + (m.scores[m.ids[piece]] if known else m.floor)
                            if s >= best:
                                choice, best = piece, s
                    start -= 1
                last.append(choice)
                score.append(best)
            before = word
            ids, end = [], len(word)
            while end:
                piece = last[end]
                ids.append(raw.get(piece) or self._unknown(piece))
                end -= len(piece)
            self.words[word] = b"".join(reversed(ids))

    def split(self, text: str) -> list[str]:
        """Marked words: joined they are the text with marks for spaces."""
        if not text:
            return []
        text = (MARK if self.model.prefix else "") + text.replace(" ", MARK)
        if not self.model.cut:
            return [text]
        parts = text.split(MARK)
        words, marks = [], ""
        if parts[0]:
            words.append(parts[0])
        for p in parts[1:]:
            marks += MARK
            if p:
                words.append(marks + p)
                marks = ""
        if marks:
            words.append(marks)
        return words

    def encode(self, texts: list[str]) -> list[bytes]:
        """int32 ids of each text, as bytes."""
        cut = [self.split(t) for t in texts]
        fresh = set().union(*cut) - self.words.keys()
        passing = len(self.words) + len(fresh) > REMEMBERED
        self.encode_words(fresh)
        out = [b"".join(map(self.words.__getitem__, words)) for words in cut]
        for word in fresh:  # the most frequent words came first and stay
            if passing or len(word) > LONGEST_REMEMBERED:
                del self.words[word]
        return out


class Decoder:
    def __init__(self, model: Model):
        self.model = model
        raw = {i: bytes([b]) for b, i in model.bytes.items()}
        self.table = [raw.get(i, p.replace(MARK, " ").encode() if t in (NORMAL, USER) else b"\xe2\x81\x87" if t == UNKNOWN else b"") for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True))]

    def decode(self, ids: bytes) -> str:
        out = b"".join(map(self.table.__getitem__, np.frombuffer(ids, np.int32).tolist()))
        if self.model.prefix and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(model: bytes) -> tuple[Encoder, Decoder]:
    """One encoder and decoder for all tasks of a worker process, so words and pairs are remembered across tasks."""
    m = Model(model)
    return Encoder(m), Decoder(m)


def _groups(column: pa.Array, most: int = 2 << 20) -> Iterable[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text."""
    sizes = np.diff(np.frombuffer(column.cast(pa.large_string()).fill_null("").combine_chunks().buffers()[1] if isinstance(column, pa.ChunkedArray) else column.fill_null("").cast(pa.large_string()).buffers()[1], np.int64)[: len(column) + 1])
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(column):
        yield start, len(column)


def read_model(path: str = MODEL) -> bytes:
    """The model file's bytes, read on the driver: some hundred kilobytes, sent with the task."""
    with open(path, "rb") as f:
        return f.read()


def _with(docs: DataFrame, column: str, kind: T.DataType, batch_values) -> DataFrame:
    docs = docs.drop(column)

    def run(batches):
        state = None
        for b in batches:
            if state is None:
                state = batch_values(None, None)
            yield pa.RecordBatch.from_arrays([*b.columns, batch_values(state, b)], [*b.schema.names, column])

    return docs.mapInArrow(tx.lean(run), T.StructType([*docs.schema.fields, T.StructField(column, kind)]))


def encode_documents(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>``.

    Null and empty texts have no ids. The ids are those of the model's own library: unknown characters
    become bytes where the model has byte pieces, else the unknown piece. Other columns stay; an
    ``ids`` column is replaced. A text without spaces is one word; time and memory are linear in it.
    """

    def values(state, b):
        if b is None:
            return codec(model)[0]
        ids, sizes = [], [np.zeros(1, np.int64)]
        column = b.column(text)
        for i, j in _groups(column):
            got = state.encode([t or "" for t in column.slice(i, j - i).to_pylist()])
            ids.append(np.frombuffer(b"".join(got), np.int32))
            sizes.append(np.array([len(x) // 4 for x in got], np.int64))
        ends = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))

    return _with(docs, "ids", T.ArrayType(T.IntegerType()), values)


def decode_documents(docs: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded string``: the text of ``ids``; empty for null or no ids."""

    def values(state, b):
        if b is None:
            return codec(model)[1]
        column = b.column(ids).fill_null([]) if b.column(ids).null_count else b.column(ids)
        ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(np.int32)
        return pa.array([state.decode(flat[s:e].tobytes()) for s, e in zip(ends[:-1], ends[1:], strict=True)], pa.string())

    return _with(docs, "decoded", T.StringType(), values)


def encode_and_check(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, both made in one pass over the text."""
    docs = docs.drop("ids", "decoded")

    def run(batches):
        encoder, decoder = codec(model)
        for b in batches:
            for i, j in _groups(b.column(text)):
                part = b.slice(i, j - i)
                got = encoder.encode([t or "" for t in part.column(text).to_pylist()])
                ends = np.cumsum([0, *[len(x) // 4 for x in got]]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.array([decoder.decode(x) for x in got], pa.string())], [*b.schema.names, "ids", "decoded"])

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return docs.mapInArrow(tx.lean(run), T.StructType([*docs.schema.fields, *fields]))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of ``documents`` under the 32k model, as a count and a hash, and whether they decode to it. See ``encode_and_check``."""
    out = encode_and_check(table(spark, sf_dir, "documents").select("doc_id", "text"), read_model())
    return out.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.hex(F.xxhash64("ids")).alias("ids_hash"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
