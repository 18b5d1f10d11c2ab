"""Token ids in a bit-packed file format with random access.

A file holds ids of ``width`` bits each, the fewest that fit the vocabulary, least significant
bit first, in blocks of ``BLOCK_IDS`` ids that start on whole bytes. A footer lists the byte
offset of each block and the id and token count of each document:

    magic | blocks | offsets int64[] | doc ids int64[] | null flags uint8[] | counts int64[]
    | header (width, block ids, blocks, documents, ids as int64) | magic
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import bound_batches, buckets_for, materialize, new_path, same_spans, span_hashes, tidy

MAGIC = b"SWIDS001"
BLOCK_IDS = 4096
END_ID = 2
#: Texts of the input in one file, as stored.
FILE_BYTES = 32 << 20
#: Files whose starts are summed together.
LOT = 1024
#: Bytes of text that are encoded together, where ids are written and where they are only counted.
CHUNK_BYTES, COUNT_BYTES = 2 << 20, 1 << 20
#: Remembered segments of a worker; bounds its memory, not what is encoded.
CACHE_SEGMENTS, COUNT_SEGMENTS = 800_000, 300_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids below 2**width as ceil(len * width / 8) bytes."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=count * width, bitorder="little").reshape(count, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _filesystem(uri: str):
    """Any store that pyarrow knows by its scheme; plain paths are local files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if re.match(r"\w+:/", uri) else "file://" + os.path.abspath(uri))


class IdWriter:
    """Streams documents into one file; memory holds one block and the document table."""

    def __init__(self, stream, width: int):
        self.stream, self.width = stream, width
        self.stream.write(MAGIC)
        self.at = len(MAGIC)
        self.rest = np.empty(0, dtype=np.uint32)
        self.offsets: list[int] = []
        self.docs: list[int] = []
        self.nulls: list[int] = []
        self.counts: list[int] = []

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents with their ids end to end and how many each has."""
        self.docs += [0 if d is None else d for d in doc_ids]
        self.nulls += [d is None for d in doc_ids]
        self.counts += counts.tolist()
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, whole, BLOCK_IDS):
            self._block(ids[i : i + BLOCK_IDS])
        self.rest = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.offsets.append(self.at)
        self.stream.write(data)
        self.at += len(data)

    def close(self) -> tuple[int, int]:
        if len(self.rest):
            self._block(self.rest)
        total = sum(self.counts)
        for x, kind in ((self.offsets, "<i8"), (self.docs, "<i8"), (self.nulls, "u1"), (self.counts, "<i8")):
            self.stream.write(np.array(x, dtype=kind).tobytes())
        head = [self.width, BLOCK_IDS, len(self.offsets), len(self.docs), total]
        self.stream.write(np.array(head, dtype="<i8").tobytes() + MAGIC)
        self.stream.close()
        return len(self.docs), total


class IdReader:
    """Random access to the ids and documents of one file."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(48, size - 48)
        if tail[40:] != MAGIC:
            raise ValueError(f"{uri} isn't a token file")
        self.width, self.block_ids, blocks, docs, self.total = (int(x) for x in np.frombuffer(tail[:40], dtype="<i8"))
        table = blocks * 8 + docs * 17
        self.end = size - 48 - table
        raw = self.file.read_at(table, self.end)
        self.offsets = np.frombuffer(raw, "<i8", blocks)
        self.docs = np.frombuffer(raw, "<i8", docs, blocks * 8)
        self.nulls = np.frombuffer(raw, "u1", docs, blocks * 8 + docs * 8)
        self.counts = np.frombuffer(raw, "<i8", docs, blocks * 8 + docs * 9)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the file, reading only the blocks that hold them."""
        if stop <= start:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        until = self.offsets[last + 1] if last + 1 < len(self.offsets) else self.end
        data = self.file.read_at(int(until - self.offsets[first]), int(self.offsets[first]))
        out = []
        for b in range(first, last + 1):
            count = min(self.block_ids, self.total - b * self.block_ids)
            at = int(self.offsets[b] - self.offsets[first])
            out.append(unpack(data[at : at + (count * self.width + 7) // 8], count, self.width))
        return np.concatenate(out)[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def close(self) -> None:
        self.file.close()


# first bytes of UTF-8 characters that are or may be white space; no cut is made before them
_STAYS = np.zeros(256, dtype=bool)
_STAYS[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b",.;:")] = True
_SOLID = np.arange(256) < 0x7F
_SOLID &= ~_STAYS & (np.arange(256) > 0x20)


class SegmentEncoder:
    """Encodes texts by segments, each remembered once the tokenizers library has encoded it.

    A byte-level tokenizer never joins what stands before a space with a space that a
    non-space character follows, nor a letter with a comma, full stop, colon or semicolon, so a
    text may be cut there and the parts' ids joined. Equal
    segments of a call are found by hashes and compared byte by byte, remembered ones are found by the bytes.
    """

    def __init__(self, path: str, most: int = CACHE_SEGMENTS):
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = bits_for(self.tokenizer.get_vocab_size())
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all UTF-8 texts end to end, without special tokens added, and how many each has."""
        size = np.array([len(t) for t in texts], dtype=np.int64)
        data = b"".join(texts)
        if not data:
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        raw = np.frombuffer(data, dtype=np.uint8)
        begins = np.cumsum(size) - size
        cut = np.zeros(len(raw) + 1, dtype=bool)
        cut[: len(raw) - 1] = (raw[:-1] == 0x20) & ~_STAYS[raw[1:]]
        # a letter never joins these marks, nor one line feed the letter after it
        letter = _LETTER[raw]
        letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        cut[1 : len(raw)] |= letter[:-1] & _MARK[raw[1:]]
        cut[2 : len(raw)] |= (raw[1:-1] == 0x0A) & _SOLID[raw[:-2]] & _LETTER[raw[2:]]
        # a text's last character is never followed by one of its own
        cut[(begins + size - 1)[size > 0]] = False
        cut[begins] = True
        cut[len(raw)] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        _, first, which = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        length = ends - starts
        # each segment is held against the first of its hash, byte by byte
        if (length != length[first[which]]).any() or not same_spans(raw, starts, starts[first[which]], length):
            every = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(p, len(number)) for p in every], dtype=np.int64)
            first = np.unique(which, return_index=True)[1]
        parts = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        known = self.known
        new = [p for p in parts if p not in known]
        if new:
            encoded = self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
            known.update((p, array("I", e.ids).tobytes()) for p, e in zip(new, encoded))
        ids = list(map(known.__getitem__, parts))
        for p in new[max(0, self.most - len(known) + len(new)) :]:
            del known[p]
        flat = np.frombuffer(b"".join(ids), dtype=np.uint32)
        length = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        at, n = (np.cumsum(length) - length)[which], length[which]
        done = np.cumsum(n)
        out = flat[np.repeat(at - done + n, n) + np.arange(done[-1])]
        upto = np.concatenate([[0], done])
        bounds = upto[np.searchsorted(starts, np.concatenate([begins, [len(raw)]]))]
        return out, np.diff(bounds)


@lru_cache(maxsize=2)
def encoder_of(path: str, most: int = CACHE_SEGMENTS) -> SegmentEncoder:
    """One encoder for all tasks of a worker."""
    return SegmentEncoder(path, most)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's ids with ``end_id`` after them."""
    return np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32), counts + 1


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ids of all documents below ``path``, in ascending doc_id order; returns the manifest.

    Manifest: part, file, n_docs, n_ids, start (ids before this file). Null texts are empty, null
    doc_ids come first, equal doc_ids are ordered by a hash of the text, then the text; each document ends with ``end_id``.
    Other columns are ignored. No rows in, no files out.
    """
    bound_batches(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    parts = buckets_for(docs, FILE_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, folder = _filesystem(path)
        fs.create_dir(folder)
        final, scratch = f"{folder}/part-{part:07d}.ids", f"{folder}/_writing-{part:07d}-{uuid.uuid4().hex}"
        encoder = writer = None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            if not ids:
                continue
            if writer is None:
                encoder = encoder_of(tokenizer)
                writer = IdWriter(fs.open_output_stream(scratch), encoder.width)
            at = 0
            while at < len(ids):
                some, size = [], 0
                while at + len(some) < len(ids) and size < CHUNK_BYTES:
                    some.append(texts[at + len(some)].as_buffer() or b"")
                    size += len(some[-1])
                writer.add(ids[at : at + len(some)], *with_end(*encoder.encode(some), end_id))
                at += len(some)
        if writer is not None:
            n_docs, n_ids = writer.close()
            fs.move(scratch, final)
            yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_ids": [n_ids]})

    # a hot id is dealt by its texts' hashes
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    written = (
        docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order, F.col("text").asc_nulls_first())
        .select("doc_id", "text")
        .mapInArrow(run, "part long, n_docs long, n_ids long")
    )
    rows = materialize(written, "manifest").withColumn("lot", F.floor(F.col("part") / LOT))
    # ids before a file: those of earlier lots of files, and of earlier files of its lot
    lots = rows.groupBy("lot").agg(F.sum("n_ids").alias("lot_ids"))
    before = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select("lot", F.coalesce(F.sum("lot_ids").over(before), F.lit(0)).alias("lot_start"))
    inside = Window.partitionBy("lot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(lots, "lot")
    file = F.format_string(f"{path.replace('%', '%%')}/part-%07d.ids", "part")
    return rows.select("part", "n_docs", "n_ids", (F.col("lot_start") + F.col("start")).cast("long").alias("start"), file.alias("file"))


def read_tokens(manifest: DataFrame, chunk_ids: int = 1 << 20) -> DataFrame:
    """One row for each stored document: doc_id, start, n_tokens, ids_crc32, read from the files.

    Null and repeated ids come back as they were written; an empty manifest gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = IdReader(file)
                at, n = 0, len(reader.docs)
                while at < n:
                    until = max(at + 1, int(np.searchsorted(reader.starts, reader.starts[at] + chunk_ids, side="right")) - 1)
                    until = min(until, n)
                    base = int(reader.starts[at])
                    ids = reader.ids(base, int(reader.starts[until])).astype("<u4")
                    crcs = [zlib.crc32(ids[reader.starts[k] - base : reader.starts[k + 1] - base].tobytes()) for k in range(at, until)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.asarray(reader.docs[at:until], dtype=np.int64), pa.int64(), mask=reader.nulls[at:until].astype(bool)),
                            pa.array(first + reader.starts[at:until], pa.int64()), pa.array(np.asarray(reader.counts[at:until], dtype=np.int64), pa.int64()), pa.array(crcs, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    at = until
                reader.close()

    files = max(1, manifest.count())
    return manifest.select("file", "start").repartition(files, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_counts(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text", column: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of ids of ``text_col`` in place of the text; null texts have none."""
    bound_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    docs = docs.drop(column)
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, COUNT_SEGMENTS)
        for batch in batches:
            texts, at, counts = batch.column(len(others)), 0, []
            while at < batch.num_rows:
                some, size = [], 0
                while at + len(some) < batch.num_rows and size < COUNT_BYTES:
                    some.append(texts[at + len(some)].as_buffer() or b"")
                    size += len(some[-1])
                counts.append(encoder.encode(some)[1])
                at += len(some)
            made = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.int64())], names=[*others, column])

    fields = [f for f in docs.schema.fields if f.name != text_col]
    rows = docs.select(*others, F.col(text_col).cast("binary").alias("_text"))
    return rows.mapInArrow(tidy(run), T.StructType([*fields, T.StructField(column, T.LongType())]))


def token_round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """What ``read_tokens`` finds in the files that ``write_tokens`` has made of ``docs``, in the shared folder.

    One row for each input row, null and repeated ids and null texts included; no rows in, none out.
    """
    path = new_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, path, tokenizer, end_id))
