"""SentencePiece encoding and decoding by shared-prefix Viterbi.

The pieces and scores of a SentencePiece model are read from its file. A text gets the usual
marked spaces and is cut into marked words (a run of marks and what follows; no piece crosses such a
cut). Distinct words are sorted, which lays their trie out depth first: a word keeps the forward
states of the prefix it shares with the word before. A state is the best way to end at a place,
found from the states before and the pieces that end there:

* Unigram models: scores are log-probabilities, and the way with the highest total wins; ties go to
  the longer last piece.
* BPE models: scores are ranks of merges, whose sum means nothing. Merging by rank gives each prefix
  one last piece: the only piece ending there that the merges of (last piece of what is before it,
  the piece) leave apart. So the same traversal with that test as its transition gives the ids of
  the merges themselves, in one pass and without a queue of pairs.

Characters without a piece become byte pieces. Decoding joins the pieces' bytes.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bound_batches

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Remembered words of a worker; bounds its memory, not what is encoded.
CACHE_WORDS = 600_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
NO_PIECE = (-math.inf, -1)
#: Number of the model kind whose scores are merge ranks.
BPE = 2
#: Remembered pairs of pieces; bounds a worker's memory.
CACHE_PAIRS = 2_000_000
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    scores: dict[str, tuple[float, int]] = field(default_factory=dict)
    byte_ids: list[int] = field(default_factory=lambda: [0] * 256)
    prefix: bool = True
    merges: bool = False
    #: trie of the reversed pieces: character -> [next characters, score, piece number or -1]
    ends: dict = field(default_factory=dict)
    unknown: float = 0.0
    apart: dict[int, bool] = field(default_factory=dict)
    made: dict[str, bool] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        m = cls()
        for number, value in _fields(data):
            if number == 1:
                parts = dict(_fields(value))
                piece, kind = parts.get(1, b"").decode(), parts.get(3, NORMAL)
                if kind == BYTE:
                    m.byte_ids[int(piece[1:-1], 16)] = len(m.pieces)
                elif kind in (NORMAL, USER):
                    m.scores.setdefault(piece, (struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0, len(m.pieces)))
                m.pieces.append(piece)
                m.kinds.append(kind)
            elif number == 2:
                m.merges = dict(_fields(value)).get(3, 1) == BPE
            elif number == 3:
                m.prefix = bool(dict(_fields(value)).get(3, 1))
        if any(MARK in p.lstrip(MARK) for p in m.scores):
            raise ValueError("a piece crosses the start of a word; words can't be encoded one by one")
        if m.merges and (USER in m.kinds or UNUSED in m.kinds):
            raise ValueError("a BPE model with user-defined or unused pieces isn't supported")
        for piece, (score, number) in m.scores.items():
            node = m.ends
            for c in piece[:0:-1]:
                node = node.setdefault(c, [{}, 0.0, -1])[0]
            node.setdefault(piece[0], [{}, 0.0, -1])[1:] = score, number
        m.unknown = min((s for s, _ in m.scores.values()), default=0.0) - UNKNOWN_PENALTY
        return m

    def merged(self, text: str) -> list[str]:
        """``text`` after all merges: the pair whose piece has the highest score first, then the leftmost."""
        parts, scores = list(text), self.scores
        pairs = [scores.get(a + b, NO_PIECE)[0] for a, b in zip(parts, parts[1:])]
        while pairs:
            top = max(pairs)
            if top == -math.inf:
                break
            i = pairs.index(top)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = scores.get(parts[i - 1] + parts[i], NO_PIECE)[0]
            if i < len(pairs):
                pairs[i] = scores.get(parts[i] + parts[i + 1], NO_PIECE)[0]
        return parts

    def stays_apart(self, left: str, right: str) -> bool:
        """Whether ``right`` is a piece that merges make, and the merges of both end at these two; '' is the start of a word."""
        own = self.made.get(right)
        if own is None:
            own = self.made[right] = self.merged(right) == [right]
        return own and (not left or self.merged(left + right) == [left, right])

    def encode_words(self, words) -> dict[str, list[int]]:
        """Ids of each distinct word, visiting the words' trie depth first."""
        return self._merge_words(words) if self.merges else self._score_words(words)

    def _ids(self, word: str, starts: list[int], numbers: list[int]) -> list[int]:
        """Ids of the way to the end of ``word``, given the last piece of each prefix and where it starts."""
        ids, end = [], len(word)
        while end:
            if numbers[end] >= 0:
                ids.append(numbers[end])
            else:
                ids.extend(self.byte_ids[b] for b in reversed(word[starts[end] : end].encode("utf-8", "surrogatepass")))
            end = starts[end]
        return ids[::-1]

    def _score_words(self, words) -> dict[str, list[int]]:
        """Unigram: the way of the highest score."""
        ends, unknown = self.ends, self.unknown
        best, starts, numbers = [0.0], [0], [-1]
        before, out = "", {}
        for word in sorted(set(words)):
            shared = len(os.path.commonprefix((before, word)))
            del best[shared + 1 :], starts[shared + 1 :], numbers[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                node, found = ends, []
                for start in range(end - 1, -1, -1):
                    at = node.get(word[start])
                    if at is None:
                        break
                    node, score, number = at
                    if number >= 0:
                        found.append((best[start] + score, -start, number))
                if not found or found[0][1] != 1 - end:
                    found.append((best[end - 1] + unknown, 1 - end, -1))
                total, start, number = max(found)
                best.append(total)
                starts.append(-start)
                numbers.append(number)
            out[word] = self._ids(word, starts, numbers)
            before = word
        return out

    def _merge_words(self, words) -> dict[str, list[int]]:
        """BPE: the only last piece of each prefix that merges leave apart from the one before it."""
        ends, apart, size = self.ends, self.apart, len(self.pieces)
        if len(apart) >= CACHE_PAIRS:
            apart.clear()
        starts, numbers = [0], [-1]
        before, out = "", {}
        for word in sorted(set(words)):
            shared = len(os.path.commonprefix((before, word)))
            del starts[shared + 1 :], numbers[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                node, found, start = ends, [], end
                while start:
                    start -= 1
                    at = node.get(word[start])
                    if at is None:
                        break
                    node = at[0]
                    if at[2] >= 0:
                        found.append((start, at[2]))
                if not found or found[0][0] != end - 1:
                    found.insert(0, (end - 1, -1))
                for start, number in reversed(found):
                    left = numbers[start]
                    if number >= 0 and (left >= 0 or not start):
                        key = (left + 1) * size + number
                        fits = apart.get(key)
                        if fits is None:
                            fits = apart[key] = self.stays_apart(word[starts[start] : start], word[start:end])
                    else:  # beside a character without a piece
                        fits = self.stays_apart(word[starts[start] : start], word[start:end])
                    if fits:
                        break
                else:  # beyond the rule above, which holds for models made by merging
                    last = self.merged(word[:end])[-1]
                    start, number = end - len(last), self.scores.get(last, (0.0, -1))[1]
                starts.append(start)
                numbers.append(number)
            out[word] = self._ids(word, starts, numbers)
            before = word
        return out

    def marked(self, text: str) -> list[str]:
        if not text:
            return []
        return WORD.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def decode_table(self) -> list[bytes]:
        table = []
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind == BYTE:
                table.append(bytes([int(piece[1:-1], 16)]))
            elif kind in (NORMAL, USER):
                table.append(piece.replace(MARK, " ").encode())
            else:
                table.append(b" \xe2\x81\x87 " if kind == UNKNOWN else b"")
        return table

    def decode(self, ids, table: list[bytes] | None = None) -> str:
        table = table or self.decode_table()
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def encoder_of(path: str) -> CachingEncoder:
    """One encoder for all tasks of a worker."""
    return CachingEncoder(PieceModel.load(path))


class CachingEncoder:
    def __init__(self, model: PieceModel):
        self.model = model
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known, asked = self.known, set()
        cut = [self.model.marked(t) for t in texts]
        for words in cut:
            asked.update(words)
        new = self.model.encode_words(asked.difference(known))
        known.update((w, array("i", ids).tobytes()) for w, ids in new.items())
        out = [np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=np.int32) for words in cut]
        for w in list(new)[max(0, CACHE_WORDS - len(known) + len(new)) :]:
            del known[w]
        return out


def encode(docs: DataFrame, model: str | None = None, text_col: str = "text", column: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col`` as an array in ``column``.

    Whole texts are encoded; null and empty texts get an empty array. Every row is kept with its
    own columns; a column of the new name is replaced.
    """
    bound_batches(docs.sparkSession)
    path = model or default_model()
    docs = docs.drop(column)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            texts = batch.column(names.index(text_col))
            at = 0
            while at < batch.num_rows:
                some, size = [], 0
                while at + len(some) < batch.num_rows and size < 1 << 21:
                    some.append(texts[at + len(some)].as_py() or "")
                    size += len(some[-1])
                ids = encoder.encode(some)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                part = batch.slice(at, len(some))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*names, column])
                at += len(some)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, model: str | None = None, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids in ``column`` as ``into``; null or empty arrays give ''."""
    path = model or default_model()
    docs = docs.drop(into)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = PieceModel.load(path)
        table = m.decode_table()
        for batch in batches:
            texts = [m.decode(x or [], table) for x in batch.column(names.index(column)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=[*names, into])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, T.StringType())]))


def digest(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and round_trip from encoded rows (doc_id, text, ids).

    round_trip: the ids decode to the text (in which a literal mark character reads as a space).
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = PieceModel.load(path)
        table = m.decode_table()
        for batch in batches:
            texts, lists = batch.column("text"), batch.column("ids")
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            n, crc, same = [], [], []
            for i in range(batch.num_rows):
                ids = flat[offsets[i] : offsets[i + 1]]
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                same.append(m.decode(ids.tolist(), table) == (texts[i].as_py() or "").replace(MARK, " "))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "text", "ids").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_crc32 long, round_trip boolean")
