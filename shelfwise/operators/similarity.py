"""Pairs of items whose token sets are alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import token_score


def similar_pairs(rows: DataFrame, keys: list[str], item: str, words: str, least: float, containment: float = 0.72) -> DataFrame:
    """(a, b, score) of each pair of different ``item``s with equal ``keys`` that scores ``least`` (above 0), the lesser first.

    ``words`` holds an item's distinct tokens in sorted order, joined by spaces; null keys match nothing.
    Each pair of different word lists is scored once, over lists that share a token, and the items with
    these words are paired after that without a look at their tokens.
    """
    kinds = rows.where(F.col(words) != "").select(*keys, F.col(words).alias("_w")).distinct()
    each = kinds.withColumn("_t", F.explode(F.split("_w", " ")))
    both = each.withColumnRenamed("_w", "_wa").hint("merge").join(each.withColumnRenamed("_w", "_wb"), [*keys, "_t"]).where("_wa <= _wb")
    a, b = F.split("_wa", " "), F.split("_wb", " ")
    once = both.where(F.col("_t") == F.get(F.array_intersect(a, b), F.lit(0)))  # each pair at the first token it shares
    alike = once.select(*keys, "_wa", "_wb", token_score(a, b, containment).alias("score")).where(F.col("score") >= least)
    left = rows.select(*keys, F.col(words).alias("_wa"), F.col(item).alias("_x"))
    right = rows.select(*keys, F.col(words).alias("_wb"), F.col(item).alias("_y"))
    pairs = left.join(alike, [*keys, "_wa"]).hint("merge").join(right, [*keys, "_wb"])
    pairs = pairs.where(((F.col("_wa") == F.col("_wb")) & (F.col("_x") < F.col("_y"))) | ((F.col("_wa") < F.col("_wb")) & (F.col("_x") != F.col("_y"))))
    return pairs.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "score")
