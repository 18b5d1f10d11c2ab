"""Idempotent upserts of captures, and first or last of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given total order, by a partial minimum."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.min(row).alias("_first")).select(*keys, *[F.col(f"_first.row.{c}").alias(c) for c in rest])


def keep_last(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key in the given total order, by a partial maximum."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.max(row).alias("_last")).select(*keys, *[F.col(f"_last.row.{c}").alias(c) for c in rest])


def _filled(c: Column, kind: str) -> Column:
    return F.nullif(c, F.lit("")) if kind == "string" else c


def upsert(old: DataFrame, new: DataFrame, keys: list[str], empty_overwrites: bool = False) -> DataFrame:
    """M1, M4 (empty values keep what was there) or M5 (values of ``new`` replace all, empty ones too). One row per key on each side.

    A column that one side lacks keeps the other side's values, as a key that a record doesn't have.
    """
    rest = list(dict.fromkeys(c for c in (*old.columns, *new.columns) if c not in keys))
    kinds = dict(new.dtypes) | dict(old.dtypes)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(True).alias("_"), *[c for c in rest if c in df.columns]).alias(name))

    def picked(c: str) -> Column:
        was, now = (F.col(f"{name}.{c}") if c in df.columns else None for name, df in (("_old", old), ("_new", new)))
        if was is None or now is None:
            return (now if was is None else was).alias(c)
        kept = F.when(F.col("_new").isNotNull(), now).otherwise(was) if empty_overwrites else F.coalesce(_filled(now, kinds[c]), was)
        return kept.alias(c)

    return packed(old, "_old").join(packed(new, "_new"), keys, "full").select(*keys, *map(picked, rest))


def pad_id(col: Column, width: int = 6) -> Column:
    """M9: zeros on the left; longer ids stay whole."""
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def keep_weight_basis(old: Column, new: Column) -> Column:
    """M9: a basis by weight isn't downgraded to one per item."""
    return F.when((old == "per lb") & (new == "per item"), old).otherwise(F.coalesce(new, old))


def protect_category(old: Column, new: Column, raw_by_weight: Column, commodities: tuple[str, ...] = ("Produce", "Meat & Seafood")) -> Column:
    """M6: a commodity category stays; a raw cut by weight is meat."""
    return F.when(raw_by_weight, "Meat & Seafood").when(old.isin(*commodities), old).otherwise(F.coalesce(F.nullif(new, F.lit("")), old))


def query_key(store: Column, query: Column, target: Column, category: Column, captured: Column, history: bool) -> Column:
    """M2, M4, M8: what a captured query is identified by; with ``history`` each capture is its own row."""
    from ..functions.text import merge_key

    base = F.when(F.coalesce(target, F.lit("")) != "", F.concat(F.lit("target:"), target)).otherwise(F.concat_ws(":", F.lit("query"), merge_key(category) if history else merge_key(store), merge_key(query)))
    return F.concat_ws(":", base, captured.cast("string")) if history else base


def merge_captures(old: DataFrame, new: DataFrame, order: str = "ordinal") -> DataFrame:
    """M4 to M6, M9: records of a new capture into those known, by padded id.

    Of rows that repeat an id the last by ``order`` counts; empty values keep what was there; columns of
    a targeted capture (target_id, target_name, target_size, target_rank) aren't kept; a basis by weight
    and a commodity category aren't downgraded, and raw meat by weight is meat.
    """
    from ..functions.claims import about_meat

    targeting = ("target_id", "target_name", "target_size", "target_rank")
    last = keep_last(new.drop(*targeting).withColumn("id", pad_id(F.col("id"))), ["id"], order).drop(order)
    known = old.select(pad_id(F.col("id")).alias("id"), F.col("price_basis").alias("_basis"), F.col("category").alias("_category"))
    both = last.join(known, "id", "left")
    basis = keep_weight_basis(F.col("_basis"), F.nullif(F.col("price_basis"), F.lit("")))
    raw = F.coalesce((basis == "per lb") & about_meat(F.col("title")), F.lit(False))
    fixed = both.withColumn("price_basis", basis).withColumn("category", protect_category(F.col("_category"), F.col("category"), raw)).drop("_basis", "_category")
    return upsert(old.withColumn("id", pad_id(F.col("id"))).drop(order), fixed, ["id"])


def identity_errors(df: DataFrame, source: str, stores: tuple[str, ...]) -> DataFrame:
    """Rows whose source or store isn't the expected one; an empty result is a pass."""
    wrong = F.when(~F.col("source").eqNullSafe(F.lit(source)), "source").when(~F.coalesce(F.col("store_id").isin(*stores), F.lit(False)), "store")
    return df.withColumn("error", wrong).where("error IS NOT NULL")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")
