"""Sharding by vector bin packing.

Groups of equal texts are never split. Each group is a vector (bytes, tokens, rows). A group that
makes up more than 1 / (``GRAIN`` * shards) of any total is placed by itself; there are at most
3 * ``GRAIN`` * shards of these, whatever the input size. The others are summed into a fixed number of
cells by a hash of the text, and cells are placed like groups. The driver places them, largest
first, each into the shard whose residual capacity vector has the highest dot product with its
vector. Law kept: ``bytes`` (near equal sizes).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize
from .token_binary import token_counts

#: Cells of small groups, and the part of a shard from which a group is placed by itself; both bound
#: what reaches the driver (some MB).
CELLS, GRAIN = 1 << 14, 1 << 10
#: Ranges of a document hash in which slots are numbered side by side: at least, at most, and rows in each.
LANES, MOST_LANES, LANE_ROWS = 1 << 10, 1 << 16, 1 << 20


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each row of ``vectors`` (items x dimensions), by the dot-product rule.

    Dimensions are scaled to a total of one; the capacity of a shard is an equal part of each.
    Only shards into which the item fits compete; if none does, the emptiest shard takes it.
    Ties go to the smaller shard number.
    """
    total = vectors.sum(axis=0, dtype=np.float64)
    scaled = vectors / np.where(total > 0, total, 1.0)
    residual = np.full((n_shards, vectors.shape[1]), 1.0 / n_shards)
    out = np.zeros(len(vectors), dtype=np.int64)
    order = np.lexsort((np.arange(len(vectors)), -scaled.max(axis=1)))
    for i in order:
        item = scaled[i]
        fits = (residual[:, 0] >= item[0]) & (residual >= item - 1e-3 / n_shards).all(axis=1)
        if fits.any():
            shard = int(np.argmax(np.where(fits, residual @ item, -np.inf)))
        else:
            shard = int(np.argmax(residual[:, 0]))
        out[i] = shard
        residual[shard] -= item
    return out


def shard_documents(docs: DataFrame, n_shards: int = 8, text_col: str = "text", id_col: str = "doc_id", tokenizer: str | None = None) -> DataFrame:
    """One row for each input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the UTF-8 length of the text (null: none) plus one; tokens are ids of the tokenizer. Slots
    are gapless from 0 in each shard, in an order fixed by (hash lane, id, text hash); rows that repeat
    id and text take neighbouring slots, rows without an id any. Other columns are ignored; no rows
    in, none out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h_b"),
        F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).alias("place"),
    )
    small = materialize(token_counts(rows, tokenizer, column="tokens"), "sizes")
    spark = docs.sparkSession
    parts = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = small.agg(*parts).first()
    lanes = min(MOST_LANES, max(LANES, total["rows"] // LANE_ROWS))
    cell = F.pmod(F.col("h"), F.lit(CELLS)).cast("int")
    small = small.withColumns({"cell": cell, "lane": F.pmod(F.xxhash64("doc_id", "h", "place"), F.lit(lanes)).cast("int")})
    groups = materialize(small.groupBy("h", "h_b").agg(*parts), "groups")
    is_large = F.lit(False)
    for column in ("bytes", "tokens", "rows"):
        is_large |= F.col(column) * (GRAIN * n_shards) > F.lit(total[column] or 0)
    names = ["bytes", "tokens", "rows"]
    large = groups.where(is_large).orderBy("h", "h_b").collect()
    cells = groups.where(~is_large).groupBy(cell.alias("cell")).agg(*(F.sum(c).alias(c) for c in names)).orderBy("cell").collect()
    shards = place(np.array([[r[c] for c in names] for r in (*large, *cells)], dtype=np.float64).reshape(-1, 3), n_shards).tolist()
    singly = spark.createDataFrame([(r["h"], r["h_b"], s) for r, s in zip(large, shards)], "h long, h_b long, own int")
    by_cell = spark.createDataFrame([(r["cell"], s) for r, s in zip(cells, shards[len(large) :])], "cell int, shared int")
    placed = small.join(F.broadcast(singly), ["h", "h_b"], "left").join(F.broadcast(by_cell), "cell", "left").withColumn("shard", F.coalesce("own", "shared"))
    counts = sorted((r["shard"], r["lane"], r["n"]) for r in placed.groupBy("shard", "lane").agg(F.count("*").alias("n")).collect())
    starts, seen = [], {}
    for shard, lane, n in counts:
        starts.append((shard, lane, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + n
    offsets = spark.createDataFrame(starts, "shard int, lane int, first long")
    order = Window.partitionBy("shard", "lane").orderBy("doc_id", "h")
    return (
        placed.withColumn("in_lane", F.row_number().over(order))
        .join(F.broadcast(offsets), ["shard", "lane"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first") + F.col("in_lane") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
