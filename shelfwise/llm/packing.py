"""Best-fit packing with conflicts.

Documents are dealt into shards of bounded size and packed shard by shard, longest piece first.
Open bins are ordered by (residual, bin number) and carry two bitmaps: the source slots and the
duplicate clusters they hold. A piece searches from the tightest bin that fits towards roomier
ones until one shares neither its cluster nor its source slot, and opens a bin if none does.
A source has ``source_slots`` slots, dealt by a hash, and only pieces of one slot exclude each other: where
a source holds a third of all rows, one slot would leave most of its bins nearly empty. With one slot no
two pieces of a source ever share a bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower
from .token_binary import token_counts

CAPACITY = 8192
SOURCE_SLOTS = 8
#: Bytes of text in one shard.
SHARD_BYTES = 8 << 20


def pack_pieces(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; pieces are taken in the given order.

    ``sources`` and ``clusters`` are bit numbers; pieces that share one never meet in a bin.
    """
    open_bins: list[tuple[int, int]] = []
    held: list[list[int]] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = 1 << source, 1 << cluster
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            maps = held[open_bins[at][1]]
            if not (maps[0] & s or maps[1] & c):
                break
            at += 1
        if at < len(open_bins):
            residual, number = open_bins.pop(at)
        else:
            residual, number = capacity, len(held)
            held.append([0, 0])
        held[number][0] |= s
        held[number][1] |= c
        bins.append(number)
        offsets.append(capacity - residual)
        insort(open_bins, (residual - size, number))
    return bins, offsets


def best_fit_pack(docs: DataFrame, capacity: int = CAPACITY, source_slots: int = SOURCE_SLOTS, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, first_token, size, shard, bin, offset.

    A document's length is the number of its token ids plus one end token; a null text has the end
    token alone. Documents above ``capacity`` are cut into pieces that fill whole bins but for the
    last; a piece holds the ids from ``first_token`` on and lies at ``offset`` of its bin. Documents
    with equal texts (A-Z lower-cased) are one cluster, a null source is a source of its own. Pieces
    of one document share its cluster. Repeated and null ids are separate documents; other columns
    are ignored; no rows in, none out. Shards depend on the rows alone, not on files or settings.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] or 0
    shards = int(total) // SHARD_BYTES + 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"), F.xxhash64(ascii_lower(text)).alias("cluster"), text.alias("text"))
    # rows without an id that share a text are told apart by their place
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    rows = token_counts(rows, tokenizer).select(
        "doc_id", "source", "cluster", (F.col("n_tokens") + 1).alias("length"),
        F.pmod(F.xxhash64("doc_id", "cluster", F.lit(1)), F.lit(source_slots)).cast("int").alias("slot"),
        F.pmod(F.xxhash64("doc_id", "cluster", place), F.lit(shards)).cast("int").alias("shard"),
    )

    def pack(shard: pa.Table) -> pa.Table:
        by = [("length", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("source", "ascending")]
        shard = shard.take(pc.sort_indices(shard, sort_keys=by))
        length = shard.column("length").to_numpy()
        n = (length - 1) // capacity + 1
        row = np.repeat(np.arange(len(length)), n)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        size = np.minimum(capacity, length[row] - piece * capacity)
        order = np.argsort(-size, kind="stable")
        row, piece, size = row[order], piece[order], size[order]
        cluster = np.unique(shard.column("cluster").to_numpy(), return_inverse=True)[1][row]
        source = shard.column("source").combine_chunks().dictionary_encode().indices.to_numpy() * source_slots + shard.column("slot").to_numpy()
        bins, offsets = pack_pieces(size.tolist(), source[row].tolist(), cluster.tolist(), capacity)
        return pa.table({
            "doc_id": shard.column("doc_id").take(pa.array(row)), "piece": pa.array(piece, pa.int32()), "first_token": pa.array(piece * capacity, pa.int64()), "size": pa.array(size, pa.int64()),
            "shard": shard.column("shard").take(pa.array(row)), "bin": pa.array(bins, pa.int64()), "offset": pa.array(offsets, pa.int64()),
        })

    return rows.groupBy("shard").applyInArrow(pack, "doc_id long, piece int, first_token long, size long, shard int, bin long, offset long")
