"""A corpus pipeline of five stages, each an operator of the ``llm`` subpackage.

Every stage takes the rows that its predecessor kept and returns them with the columns of documents,
but for the last, which returns the places of their pieces. In every stage a null text counts as
empty, rows without an id stay rows of their own, rows that repeat an id are told apart, extra
columns stay as they are, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import exact_dedup, ngram_join, packing, secrets, toxicity
from shelfwise.llm.common import bound_batches, discard, materialize, shrink_heaps, table

#: Bytes of text in an Arrow batch of a stage's Python workers.
BATCH_BYTES = 1 << 20


def _begin(spark: SparkSession) -> None:
    """All stages run in the same executors, whose heap and workers together have one limit."""
    bound_batches(spark, size=BATCH_BYTES)
    shrink_heaps(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; a score on it is rejected, empty texts stay.

    The classifier is fitted on labelled rows of ``docs``; without any all documents stay.
    """
    _begin(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "_toxicity").where(f"_toxicity < {toxicity.THRESHOLD}").drop("_toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts (A-Z lower-cased) the row with the largest id, null ids being least;
    of rows that repeat id and text one. Null and empty texts are one group."""
    _begin(spark)
    return exact_dedup.keep_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest id, null ids being last; of rows with that
    id the one with the least text hash. Texts without words have no near copies and all stay."""
    _begin(spark)
    return ngram_join.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret values in their texts replaced by a mark; null texts stay null."""
    _begin(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence; an empty text has its end token alone."""
    _begin(spark)
    return packing.best_fit_pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("best_fit_packing", pack),
]

#: The classifier and the packing order are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what a stage has kept is written, and the one before deleted."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
