"""Exact deduplication by deterministic block naming, in DataFrame operations only.

Every text is cut into blocks of a fixed number of characters. Equal blocks get one integer
name; then names of adjacent blocks are paired and the pairs named again, halving the sequence
each round, until every document is left with one name. Names stand for contents, never for
hashes of contents, so two documents share (number of blocks, name) only if their texts are equal.

A name is the smallest occurrence number of the block or pair. It comes from a partial
aggregation, so a block that fills a third of all rows is reduced before it is shuffled, and
names return to occurrences by a sort-merge join whose hot keys adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, materialize, split_by_key

BLOCK_CHARS = 4096
#: Texts of more blocks are cut in one pass; cutting block by block counts from the start each time.
MANY_BLOCKS = 16


def block_names(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each input row: (row_no, doc_id, text_sha256, n_blocks, name).

    Null text counts as empty, an empty text is one empty block. Rows are told apart by row
    number, so null or repeated ids are allowed; other columns are ignored. An empty table
    gives no rows.
    """
    norm = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(id_col).alias("doc_id"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("t"),
    )
    size = F.greatest(F.lit(1), F.ceil(F.length("t") / F.lit(block_chars)).cast("int"))
    one_by_one = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(F.col("t"), i * block_chars + 1, F.lit(block_chars)))
    at_once = F.regexp_extract_all("t", F.lit("(?s)(.{1,%d})" % block_chars), 1)
    blocks = norm.select(
        "row_no", "doc_id", size.alias("n_blocks"), F.sha2(F.col("t"), 256).alias("text_sha256"),
        F.posexplode(F.when(size > MANY_BLOCKS, at_once).otherwise(one_by_one)).alias("pos", "block"),
    )
    occurrence = F.monotonically_increasing_id()
    names = blocks.select("block", occurrence.alias("no")).groupBy("block").agg(F.min("no").alias("name"))
    level = blocks.select(
        "row_no", "doc_id", "n_blocks", "pos", "block",
        F.when(F.col("pos") == 0, F.col("text_sha256")).alias("text_sha256"),
    ).join(names, "block").drop("block")
    level = materialize(level, "names")
    keep = level
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    done = level.where("n_blocks = 1").select("row_no", "name")
    level = level.where("n_blocks > 1").select("row_no", "pos", "name", F.col("n_blocks").alias("left_over"))
    while longest > 1:
        halved = (
            level.groupBy("row_no", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"),
                F.shiftright(F.max("left_over") + 1, 1).alias("left_over"),
            )
            .select("row_no", "pos", "a", F.coalesce("b", F.lit(-1)).alias("b"), "left_over")
        )
        halved = materialize(halved, "pairs")
        names = halved.select("a", "b", F.monotonically_increasing_id().alias("no")).groupBy("a", "b").agg(F.min("no").alias("name"))
        named = materialize(halved.join(names, ["a", "b"]).select("row_no", "pos", "name", "left_over"), "names")
        discard(halved)
        done = done.unionByName(named.where("left_over = 1").select("row_no", "name"))
        level = named.where("left_over > 1")
        longest = (longest + 1) // 2
    head = keep.where("pos = 0").select("row_no", "doc_id", "text_sha256", "n_blocks")
    return head.join(done, "row_no")


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Of a group the row with the largest
    id stays (of several rows with that id, the one with the largest row number); null ids sort first.
    """
    named = materialize(block_names(docs, text_col, id_col, block_chars), "identity")
    groups = named.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row_no")).alias("last"), F.count("*").alias("group_size")
    )
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("last.row_no")).alias("kept"),
        "text_sha256",
    )


def keep_exact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the row that stays of each group of equal texts, all its columns unchanged."""
    found = materialize(exact_dedup(docs, text_col, id_col).select("doc_id", "kept", "text_sha256"), "kept")
    some, rest = split_by_key(docs, found.where("NOT kept").select(F.col("doc_id").alias(id_col)), id_col)
    kept = found.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    named = some.withColumn("_norm_sha", F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256))
    named = named.join(kept, named[id_col].eqNullSafe(F.col("_id")) & (F.col("_norm_sha") == F.col("_sha")), "left_semi")
    # rows that repeat id and text
    return rest.unionByName(named.dropDuplicates([id_col, "_norm_sha"]).drop("_norm_sha"))
