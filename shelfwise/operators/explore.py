"""Filtering, sorting and gap finding over products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.claims import DIETS, diet_claim
from ..functions.regex import has
from .prices import by_product


def explore(
    products: DataFrame, current: DataFrame, stores: tuple[str, ...], selected: tuple[str, ...] = (), require_all: bool = False, search: str = "",
    category: str = "", diet: str = "all", winner: str = "", sale_only: bool = False, sort: str = "spread", limit: int | None = 48, offset: int = 0,
) -> DataFrame:
    """Products (product_id, name, category, size, on_sale) with their ``current`` prices, filtered and sorted.

    One selected store must price the product, eligible or not; several need two eligible prices, or
    all with ``require_all``. A winner is a store that alone has the lowest price, or "tie".
    """
    chosen = selected or stores
    out = products.join(by_product(current, chosen, len(chosen) == 1), "product_id")
    prices = F.array_compact(F.array(*[F.col(s) for s in chosen]))
    out = out.withColumn("usable", F.size(prices)).withColumn("lowest", F.array_min(prices))
    out = out.withColumn("spread_cents", F.when(F.col("usable") > 1, F.array_max(prices) - F.array_min(prices)).otherwise(0))
    out = out.where(F.col("usable") >= (1 if len(chosen) == 1 else len(chosen) if require_all else 2))
    if search:
        out = out.where(F.contains(F.lower(F.concat_ws(" ", "name", "size", "category")), F.lit(search.lower())))
    if category:
        out = out.where(F.col("category") == category)
    if diet != "all":
        out = out.where(diet_claim(F.col("name"), F.col("size"), diet))
    if winner == "tie":
        out = out.where(F.size(F.filter(prices, lambda p: p == F.col("lowest"))) > 1)
    elif winner:
        out = out.where((F.col(winner) == F.col("lowest")) & (F.size(F.filter(prices, lambda p: p == F.col("lowest"))) == 1))
    if sale_only:
        out = out.where("on_sale")
    name, by_category = F.collate("name", "UNICODE"), F.collate("category", "UNICODE")
    first = {"spread": [F.desc("spread_cents")], "price": [F.asc("lowest")], "category": [F.asc(by_category)], "name": []}[sort]
    out = out.orderBy(*first, F.asc(name), F.asc("product_id")).select("product_id", "name", "category", "lowest", "spread_cents")
    return out.offset(offset).limit(limit) if limit is not None else out


def missing_stores(wide: DataFrame, stores: tuple[str, ...], have: int) -> DataFrame:
    """Products that exactly ``have`` stores price, and the stores that don't."""
    gaps = F.array_compact(F.array(*[F.when(F.col(s).isNull(), F.lit(s)) for s in stores]))
    return wide.select("product_id", gaps.alias("g")).where(F.size("g") == len(stores) - have).select("product_id", F.array_join("g", ",").alias("missing"))


def frontier(items: DataFrame, stores: Column, tried: Column, commodity: Column, limit: int = 40) -> DataFrame:
    """The ``limit`` items most worth another search; ties by id."""
    priority = stores * 100 + F.when(tried, 0).otherwise(25) + F.when(commodity, 5).otherwise(0)
    return items.select("product_id", priority.cast("long").alias("priority")).orderBy(F.desc("priority"), "product_id").limit(max(1, limit))


def core_gaps(wide: DataFrame, stores: tuple[str, ...]) -> DataFrame:
    """Priority of completing a product, and the first store that lacks it."""
    gaps = F.array_compact(F.array(*[F.when(F.col(s).isNull(), F.lit(s)) for s in stores]))
    return wide.select("product_id", F.size(gaps).alias("n"), F.get(gaps, F.lit(0)).alias("next_store")).where("n BETWEEN 1 AND 4").select(
        "product_id", "next_store", ((4 - F.col("n")) * 1000 + 105).cast("long").alias("priority")
    )


def numeric_id_order(id_: Column) -> list[Column]:
    """O2, M3: digits first and by value whatever their length, then text; ids of one value by their text."""
    digits = id_.rlike("^[0-9]+$")
    bare = F.ltrim(id_, F.lit("0"))
    return [F.when(digits, 0).otherwise(1), F.when(digits, F.length(bare)).otherwise(0), F.when(digits, bare).otherwise(id_), id_]


def name_order(name: Column) -> list[Column]:
    """O1: names as a reader sorts them (letters before case and accents), then by code point."""
    return [F.collate(name, "UNICODE"), name]


def top_of_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; the limit runs before the shuffle as well."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= k)


def claim_counts(products: DataFrame) -> DataFrame:
    """How many products (name, size) make each diet claim."""
    return products.agg(*[F.count_if(diet_claim(F.col("name"), F.col("size"), d)).alias(d.replace("-", "_")) for d in DIETS])


def unresolved(records: DataFrame, limit: int = 40) -> DataFrame:
    """Excluded records most worth resolving.

    ``records`` has store_id, id, canonical_id, category, eligible and exclusion_reason. A product's
    eligible stores count 100 each, stores with the same captured id 30, stores that captured the
    product 10, a commodity 20 and an unverified weight 10.
    """
    stores = records.groupBy("canonical_id").agg(F.count_distinct(F.when(F.col("eligible"), F.col("store_id"))).alias("eligible_stores"), F.count_distinct("store_id").alias("captured_stores"))
    same = records.groupBy("id").agg(F.count_distinct("store_id").alias("same_id_stores"))
    commodity = has(F.coalesce("category", F.lit("")), r"\b(?:produce|meat|seafood)\b", True)
    priority = (
        F.col("eligible_stores") * 100 + F.col("same_id_stores") * 30 + F.col("captured_stores") * 10 + F.when(commodity, 20).otherwise(0)
        + F.when(F.col("exclusion_reason") == "unverified_variable_weight_price", 10).otherwise(0)
    )
    open_ = records.where("NOT eligible").join(stores, "canonical_id").join(same, "id")
    return open_.select("store_id", "id", "canonical_id", "exclusion_reason", priority.alias("priority")).orderBy(F.desc("priority"), *numeric_id_order(F.col("canonical_id")), "store_id", "id").limit(limit)


def chunks(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """Global position and chunk number in a total order, numbered without one task.

    Rows are range-partitioned; each range's start comes from the counts of those before it, one
    number per partition.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    from .matching import cut

    path = cut(ranged.withColumn("_i", F.monotonically_increasing_id()))
    counts = sorted((r["_p"], r["n"], r["first"]) for r in path.groupBy("_p").agg(F.count("*").alias("n"), F.min("_i").alias("first")).collect())
    starts, at = [], 0
    for p, n, first in counts:
        starts.append((p, at - first))
        at += n
    shift = df.sparkSession.createDataFrame(starts or [(0, 0)], "_p int, _shift long")
    out = path.join(F.broadcast(shift), "_p").withColumn("position", F.col("_i") + F.col("_shift"))
    return out.withColumn("chunk", F.floor(F.col("position") / rows).cast("long")).drop("_p", "_i", "_shift")


def place_in_group(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """O2, M3: ``df`` with each row's place (from 1) in its group, in a total order.

    Rows are numbered over all groups by ranges, then each group's first number is taken off, so a
    large group is never sorted in one task.
    """
    names = [f"_o{i}" for i in range(len(order))]
    numbered = chunks(df.select("*", *[c.alias(n) for c, n in zip(order, names)]), [group, *names], 1).drop("chunk", *names)
    first = numbered.groupBy(F.col(group).alias("_g")).agg(F.min("position").alias("_first"))
    return numbered.join(first, F.col(group).eqNullSafe(F.col("_g"))).withColumn("place", (F.col("position") - F.col("_first") + 1).cast("int")).drop("_g", "_first", "position")
