"""The packaged-variant rules over all pairs of a block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import variants
from .matching import cut

#: Up to so many kinds of text their verdicts are one table of bits, 2 MB at most; beyond it kinds are
#: judged block by block. Verdicts are the same either way.
KINDS = 4096


def _numbered(kinds: DataFrame) -> DataFrame:
    """At most ``KINDS`` rows with a number from 0."""
    return kinds.withColumn("n", F.row_number().over(Window.orderBy("kind")) - 1)


def verdicts(kinds: DataFrame, count: int) -> DataFrame:
    """(kind, n, clash) of numbered ``kinds``: bit r of the longs ``clash`` tells that it conflicts with number r on its right."""
    made = cut(kinds.select("n", variants.features_of(F.col("kind")).alias("f")))
    spread = made.repartition(4 * kinds.sparkSession.sparkContext.defaultParallelism, "n")
    pairs = spread.select(F.col("n").alias("l"), F.col("f").alias("x")).crossJoin(F.broadcast(made.select(F.col("n").alias("r"), F.col("f").alias("y"))))
    hits = pairs.where(variants.conflict(F.col("x"), F.col("y"))).select("l", (F.col("r") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, r % 64)").alias("bit"))
    words = hits.groupBy("l", "w").agg(F.bit_or("bit").alias("bits")).groupBy("l").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
    row = F.transform(F.sequence(F.lit(0), F.lit((count - 1) // 64)), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long")))
    return kinds.join(words, kinds["n"] == words["l"], "left").select("kind", "n", row.alias("clash"))


def _all_pairs(left: DataFrame, right: DataFrame, on: list[str], compatible: Column) -> DataFrame:
    return left.hint("merge").join(right, on).where("left_id < right_id").select("left_id", "right_id", compatible.alias("compatible"))


def variant_pairs(items: DataFrame, keys: list[str], item: str, text: str) -> DataFrame:
    """(left_id, right_id, compatible) of all pairs of ``item``s with equal ``keys``, the lesser first.

    Many texts look alike to the rules (``variants.kind``): those of one kind are judged once against
    those of another, in both orders, since a rule's context may span the two texts.
    """
    texts = items.select(F.col(text).alias("v")).distinct()
    texts = cut(texts.repartition(items.sparkSession.sparkContext.defaultParallelism, "v").select("v", variants.kind(F.col("v")).alias("kind")))
    kinds = cut(texts.select("kind").distinct())
    rows = items.select(*keys, F.col(item).alias("id"), F.col(text).alias("v"))
    count = kinds.count()
    if count <= KINDS:
        told = cut(verdicts(cut(_numbered(kinds)), count))
        of = texts.join(F.broadcast(told), F.to_json(texts["kind"]) == F.to_json(told["kind"])).select("v", "n", "clash")
        rows = cut(rows.join(of.hint("merge"), "v").drop("v"))
        left = rows.select(*keys, F.col("id").alias("left_id"), "clash")
        right = rows.select(*keys, F.col("id").alias("right_id"), F.col("n").alias("r"))
        return _all_pairs(left, right, keys, F.expr("getbit(clash[cast(r / 64 as int)], r % 64) = 0"))
    rows = cut(rows.join(texts.hint("merge"), "v").drop("v"))
    held = cut(rows.select(*keys, "kind").distinct().select(*keys, "kind", variants.features_of(F.col("kind")).alias("f")))
    a, b = held.select(*keys, F.col("kind").alias("ka"), F.col("f").alias("x")), held.select(*keys, F.col("kind").alias("kb"), F.col("f").alias("y"))
    judged = a.hint("merge").join(b, keys).select(*keys, F.to_json("ka").alias("ka"), F.to_json("kb").alias("kb"), (~variants.conflict(F.col("x"), F.col("y"))).alias("compatible"))
    named = rows.select(*keys, "id", F.to_json("kind").alias("k"))
    left = named.toDF(*keys, "left_id", "ka").hint("merge").join(judged, [*keys, "ka"])
    return _all_pairs(left, named.toDF(*keys, "right_id", "kb"), [*keys, "kb"], F.col("compatible"))
