"""Current prices, comparison of stores, baskets and audits over price observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def share(part: Column, whole: Column, places: int = 1) -> Column:
    """Percent to ``places`` decimals, halves up; a whole below one counts as one."""
    scale = 10.0**places
    return F.floor(part / F.greatest(F.lit(1), whole) * 100 * scale + 0.5) / scale


def current_prices(obs: DataFrame) -> DataFrame:
    """Per product and store the eligible, then latest, then cheapest observation; undated ones last.

    A partial minimum of one struct, so no group of observations is ever gathered or sorted.
    """
    order = F.struct(
        (~F.col("eligible")).alias("late"), F.col("observed_at").isNull().alias("undated"), (-F.unix_micros(F.col("observed_at").cast("timestamp"))).alias("age"),
        "price_cents", "price_basis", "on_sale", "eligible", "observed_at",
    )
    best = obs.groupBy("product_id", "store_id").agg(F.min(order).alias("b"))
    return best.select("product_id", "store_id", *[F.col(f"b.{c}").alias(c) for c in ("observed_at", "price_cents", "price_basis", "eligible", "on_sale")])


def by_product(current: DataFrame, stores: tuple[str, ...], any_price: bool = False) -> DataFrame:
    """One row per product with a cents column for each store; eligible prices only, or any."""
    return (current if any_price else current.where("eligible")).groupBy("product_id").agg(*[F.min(F.when(F.col("store_id") == s, F.col("price_cents"))).alias(s) for s in stores])


def pairwise_basket(current: DataFrame, stores: tuple[str, ...]) -> DataFrame:
    """A4: every pair of stores over the products both price; empty pairs are rows of zeros.

    Products are pivoted to one row each, and the pairs of a row are exploded from its few stores,
    so no self-join of the prices is needed.
    """
    pairs = [(a, b) for i, a in enumerate(stores) for b in stores[i + 1 :]]
    wide = by_product(current, stores)
    one = F.explode(F.array(*[F.struct(F.lit(a).alias("store_a"), F.lit(b).alias("store_b"), F.col(a).alias("pa"), F.col(b).alias("pb")) for a, b in pairs]))
    shared = wide.select(one.alias("p")).select("p.*").where("pa IS NOT NULL AND pb IS NOT NULL")
    zero = F.lit(0).cast("long")

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), zero)

    found = shared.groupBy("store_a", "store_b").agg(
        F.count("*").alias("shared"), total(F.col("pa")).alias("total_a"), total(F.col("pb")).alias("total_b"),
        F.count_if(F.col("pa") < F.col("pb")).alias("wins_a"), F.count_if(F.col("pb") < F.col("pa")).alias("wins_b"), F.count_if(F.col("pa") == F.col("pb")).alias("ties"),
    )
    all_pairs = current.sparkSession.createDataFrame(pairs, "store_a string, store_b string")
    out = all_pairs.join(found, ["store_a", "store_b"], "left").fillna(0)
    a, b = F.col("total_a"), F.col("total_b")
    return out.select(
        "*", F.when(a < b, F.col("store_a")).when(b < a, F.col("store_b")).alias("cheaper"),
        F.abs(a - b).alias("savings_cents"), share(F.abs(a - b), F.greatest(a, b)).alias("savings_percent"),
    )


def store_performance(current: DataFrame, all_opponents: bool = True) -> DataFrame:
    """A5: matchups of each store's eligible prices, and its price index.

    With ``all_opponents`` opponents count whether or not they are eligible (A5q), else eligible only.
    """
    price = F.struct("store_id", "price_cents", "eligible")
    per = current.groupBy("product_id").agg(F.collect_list(price).alias("prices"))
    others = F.filter("prices", lambda o: (o["store_id"] != F.col("p.store_id")) & (F.lit(all_opponents) | o["eligible"]))
    own = per.select("prices", F.explode(F.filter("prices", lambda p: p["eligible"])).alias("p"))
    fair = F.filter("prices", lambda o: o["eligible"])
    mean = F.aggregate(fair, F.lit(0).cast("long"), lambda acc, o: acc + o["price_cents"]) / F.size(fair)

    def matchups(test) -> Column:
        return F.sum(F.size(F.filter(others, test)).cast("long"))

    found = own.groupBy(F.col("p.store_id").alias("store_id")).agg(
        F.count_if(F.size(fair) > 1).alias("comparable"),
        matchups(lambda o: F.col("p.price_cents") < o["price_cents"]).alias("wins"),
        matchups(lambda o: F.col("p.price_cents") > o["price_cents"]).alias("losses"),
        matchups(lambda o: F.col("p.price_cents") == o["price_cents"]).alias("ties"),
        F.sum(F.floor(F.col("p.price_cents") / mean * 1000000 + 0.5).cast("long")).alias("ratio"), F.count("*").alias("n"),
    )
    return found.select(
        "store_id", "comparable", "wins", "losses", "ties", share(F.col("wins"), F.col("wins") + F.col("losses")).alias("win_rate"),
        (F.floor(F.col("ratio") / F.col("n") / 1000 + 0.5) / 10).alias("price_index"),
    )


def category_rollup(current: DataFrame, products: DataFrame, n_stores: int) -> DataFrame:
    """Catalog size of each category and products that every store prices."""
    full = current.where("eligible").groupBy("product_id").agg(F.count("*").alias("k"))
    return (
        products.join(full, "product_id", "left").groupBy("category")
        .agg(F.count("*").alias("catalog"), F.count_if(F.col("k") == n_stores).alias("in_all_stores"))
    )


def coverage_histogram(current: DataFrame, products: DataFrame, n_stores: int) -> DataFrame:
    """Products by the number of stores that price them, every bucket present."""
    k = current.where("eligible").groupBy("product_id").agg(F.count("*").cast("int").alias("stores"))
    counted = products.select("product_id").join(k, "product_id", "left").fillna(0, ["stores"]).groupBy("stores").agg(F.count("*").alias("products"))
    buckets = current.sparkSession.range(n_stores + 1).select(F.col("id").cast("int").alias("stores"))
    return buckets.join(counted, "stores", "left").fillna(0, ["products"])


def basis_election(obs: DataFrame) -> DataFrame:
    """The basis with a unique plurality of eligible rows wins, else the product has none."""
    counts = obs.where("eligible").groupBy("product_id", "price_basis").agg(F.count("*").alias("n"))
    top = counts.groupBy("product_id").agg(F.max(F.struct("n", "price_basis")).alias("t"), F.array_sort(F.collect_list("n")).alias("ns"))
    tie = F.coalesce(F.get("ns", F.size("ns") - 2) == F.col("t.n"), F.lit(False)) & (F.size("ns") > 1)
    return top.select("product_id", F.when(~tie, F.col("t.price_basis")).alias("basis"), F.col("t.n").alias("support"))


def exclude_other_bases(obs: DataFrame) -> DataFrame:
    """Q3: rows with ``eligible`` withdrawn where their basis wasn't elected, and the reason."""
    out = obs.join(basis_election(obs).select("product_id", F.col("basis").alias("_basis")), "product_id", "left")
    keep = F.coalesce(F.col("price_basis") == F.col("_basis"), F.lit(False))
    return out.withColumn("exclusion_reason", F.when(F.col("eligible") & ~keep, "incompatible_product_price_basis").otherwise("")).withColumn("eligible", F.col("eligible") & keep).drop("_basis")


def markup_summary(current: DataFrame, ours: str, theirs: str) -> DataFrame:
    """Differences of one store's prices from another's; the median is the upper one."""
    wide = by_product(current, (ours, theirs)).where(F.col(ours).isNotNull() & F.col(theirs).isNotNull())
    d = wide.select((F.col(ours) - F.col(theirs)).alias("d"))
    return d.agg(
        F.count("*").alias("products"), F.count_if(F.col("d") > 0).alias("dearer"), F.count_if(F.col("d") < 0).alias("cheaper"), F.count_if(F.col("d") == 0).alias("equal"),
        F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("total_cents"),
        F.coalesce(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY d DESC)"), F.lit(0)).cast("long").alias("median_cents"),
    )


def most_common(df: DataFrame, key: str, value: str, ordinal: str) -> DataFrame:
    """A1: the commonest non-empty value; ties to the longest, then the first seen."""
    counts = df.where((F.col(value).isNotNull()) & (F.col(value) != "")).groupBy(key, value).agg(F.count("*").alias("n"), F.min(ordinal).alias("first"))
    best = counts.groupBy(key).agg(F.max(F.struct("n", F.length(value).alias("len"), (-F.col("first")).alias("early"), F.col(value).alias("v"))).alias("b"))
    return best.select(key, F.col("b.v").alias(value), F.col("b.n").alias("n"))


def spread(current: DataFrame) -> DataFrame:
    """Spread of the prices of a product (0 below two) and all its cheapest stores."""
    per = current.where("eligible").groupBy("product_id").agg(F.min("price_cents").alias("lowest"), F.max("price_cents").alias("highest"), F.count("*").alias("stores"), F.collect_list(F.struct("price_cents", "store_id")).alias("all"))
    cheap = F.sort_array(F.transform(F.filter("all", lambda p: p["price_cents"] == F.col("lowest")), lambda p: p["store_id"]))
    return per.select("product_id", "stores", (F.col("highest") - F.col("lowest")).alias("spread_cents"), F.array_join(cheap, ",").alias("lowest_stores"))


def sanitize_basket(basket: DataFrame, products: DataFrame, most: int = 99) -> DataFrame:
    """B1: known products, finite positive quantities, whole numbers up to ``most``; below one gives 0."""
    q = F.col("quantity").cast("double")
    fine = basket.where((q > 0) & (q < float("inf")) & ~F.isnan(q)).withColumn("quantity", F.least(F.lit(most), F.floor(q)).cast("int"))
    return fine.join(products.select("product_id"), "product_id", "left_semi")


def compare_basket(basket: DataFrame, current: DataFrame, stores: tuple[str, ...], list_missing: bool = False) -> DataFrame:
    """B2: total of the basket at each store, complete baskets first, then fewer missing, cheaper, store order.

    ``list_missing`` adds the products that a store lacks, in order; a shopper's basket is small.
    """
    wide = basket.join(by_product(current, stores), "product_id", "left")
    one = F.explode(F.array(*[F.struct(F.lit(s).alias("store_id"), F.lit(i).alias("place"), F.col(s).alias("price")) for i, s in enumerate(stores)]))
    each = wide.select("product_id", "quantity", one.alias("p")).select("product_id", "quantity", "p.*")
    lacking = [F.sort_array(F.collect_list(F.when(F.col("price").isNull(), F.col("product_id")))).alias("missing_ids")] if list_missing else []
    total = each.groupBy("store_id", "place").agg(
        F.coalesce(F.sum(F.col("price") * F.col("quantity")), F.lit(0)).cast("long").alias("total_cents"), F.count_if(F.col("price").isNull()).alias("missing"), *lacking,
    )
    order = Window.orderBy(F.col("missing"), F.col("total_cents"), F.col("place"))
    listed = ["missing_ids"] if list_missing else []
    return total.withColumn("rank", F.row_number().over(order)).select("store_id", "total_cents", "missing", (F.col("missing") == 0).alias("complete"), "rank", *listed)


def basket_verdict(compared: DataFrame) -> DataFrame:
    """The stores with the cheapest complete basket, and what it saves against the next dearer one (null without one)."""
    full = compared.where("complete")
    least = full.agg(F.min("total_cents").alias("cheapest"))
    both = full.join(F.broadcast(least))  # one row
    return both.groupBy("cheapest").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("total_cents") == F.col("cheapest"), F.col("store_id")))), ",").alias("stores"),
        (F.min(F.when(F.col("total_cents") > F.col("cheapest"), F.col("total_cents"))) - F.first("cheapest")).alias("saving_cents"),
    )


def strict_common(current: DataFrame, stores: tuple[str, ...]) -> DataFrame:
    """Products that every one of the stores prices."""
    wide = by_product(current, stores)
    test = F.lit(True)
    for s in stores:
        test &= F.col(s).isNotNull()
    return wide.where(test)


def category_breakdown(current: DataFrame, products: DataFrame, stores: tuple[str, ...]) -> DataFrame:
    """Of each category over the strict common products their number, each store's total and the cheapest store."""
    common = strict_common(current, stores).join(products.select("product_id", "category"), "product_id")
    out = common.groupBy("category").agg(F.count("*").alias("products"), *[F.sum(s).alias(s) for s in stores])
    first = F.array_min(F.array(*[F.struct(F.col(s).alias("t"), F.lit(i).alias("i"), F.lit(s).alias("s")) for i, s in enumerate(stores)]))
    return out.withColumn("leader", first["s"])


def snapshot_baskets(current: DataFrame, stores: tuple[str, ...]) -> DataFrame:
    """Each store's total over the strict common products, its rank, and the most that a choice of store saves."""
    total = strict_common(current, stores).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stores])
    rows = F.array(*[F.struct(F.col(s).alias("total_cents"), F.lit(i).alias("place"), F.lit(s).alias("store_id")) for i, s in enumerate(stores)])
    ranked = total.select(F.posexplode(F.sort_array(rows)).alias("at", "x"), (F.greatest(*stores) - F.least(*stores)).alias("saving_cents"))
    return ranked.select("x.store_id", "x.total_cents", (F.col("at") + 1).alias("rank"), "saving_cents")


def least_pair(pairs: DataFrame) -> DataFrame:
    """The fewest products that any pair of stores shares."""
    return pairs.agg(F.min("shared").alias("least_shared"))


def dominant_basis(current: DataFrame) -> DataFrame:
    """Of each product its eligible stores by basis; the basis of most stores leads, ties to the first in order."""
    per = current.where("eligible").groupBy("product_id", "price_basis").agg(F.array_sort(F.collect_set("store_id")).alias("stores"))
    best = per.groupBy("product_id").agg(F.min(F.struct((-F.size("stores")).alias("n"), "price_basis", "stores")).alias("b"), F.count("*").alias("bases"))
    return best.select("product_id", F.col("b.price_basis").alias("basis"), F.array_join("b.stores", ",").alias("stores"), "bases")


def category_duel(wide: DataFrame, products: DataFrame, ours: str, theirs: str) -> DataFrame:
    """Of each category the totals of two stores over the products both price, wins, ties and the difference in percent."""
    both = wide.where(F.col(ours).isNotNull() & F.col(theirs).isNotNull()).join(products.select("product_id", "category"), "product_id")
    a, b = F.col(ours), F.col(theirs)
    out = both.groupBy("category").agg(
        F.count("*").alias("products"), F.sum(a).alias("total_a"), F.sum(b).alias("total_b"), F.count_if(a < b).alias("wins_a"), F.count_if(b < a).alias("wins_b"), F.count_if(a == b).alias("ties"),
    )
    gap = F.col("total_b") - F.col("total_a")
    return out.select("*", gap.alias("difference_cents"), (F.floor(gap / F.col("total_b") * 1000 + 0.5) / 10).alias("difference_percent"), F.when(gap > 0, ours).when(gap < 0, theirs).otherwise("Tie").alias("winner"))


def assert_one_basis(obs: DataFrame) -> None:
    """Stops a load whose eligible rows mix bases within a product."""
    if not mixed_basis(obs).isEmpty():
        raise ValueError("eligible observations of a product mix price bases")


def mixed_basis(obs: DataFrame) -> DataFrame:
    """Q8: products whose eligible rows mix bases."""
    return obs.where("eligible").groupBy("product_id").agg(F.count_distinct("price_basis").alias("bases")).where("bases > 1")
