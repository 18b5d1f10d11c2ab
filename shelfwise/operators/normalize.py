"""Records of captures with one price, one basis and a verdict on whether they can be compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.regex import has
from ..functions.units import ambiguous_beverage, detail_error, parse_unit_text, positive, round_half_up, unverified_variable_weight

# Words that tell whether a card's rate by weight is the selling basis.
FIXED_PACKAGE = r"\b(?:bag|bagged|bowl|bunch|clamshell|count|ct|cut|diced|florets|pack|peeled|prepacked|sliced|stalks|tray)\b"
RAW_MEAT = r"\b(?:beef|bison|chicken|cod|crab|fish|halibut|lamb|lobster|pork|salmon|scallop|shrimp|steak|trout|turkey|veal)\b"
PREPARED = r"\b(?:bacon|breaded|burger|cooked|corned|deli|frank|grilled|hot dog|jerky|kabob|marinated|meatball|meatloaf|nugget|patty|roasted|sausage|seasoned|shredded|skewer|smoked|stuffed)\b"
MEATLESS = r"\b(?:meatless|plant based|vegan|vegetarian)\b"
LOOSE_PRODUCE = r"\b(?:apple|avocado|banana|broccoli|cabbage|celery root|cucumber|eggplant|grapefruit|jalapeno|lemon|lime|melon|orange|onion|parsnip|pepper|pluot|squash|tomato|yam)\b"
RANDOM_WEIGHT_ID = r"^002\d{10}$"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def detail_errors(details: DataFrame) -> DataFrame:
    """Weight details that can't be used, each with its error; an empty result is a pass.

    Repeated (store, id) keys are an error of every row that has the key.
    """
    error = detail_error(F.col("id"), F.col("store_id"), F.col("url"), F.col("pricing_mode"), F.col("price_basis"), F.col("item_price"), F.col("unit_price"))
    repeated = details.groupBy("store_id", "id").agg(F.count("*").alias("rows")).where("rows > 1").select("store_id", "id", F.lit("duplicate_key").alias("again"))
    return details.withColumn("error", error).join(repeated, ["store_id", "id"], "left").withColumn("error", F.coalesce("error", "again")).where("error IS NOT NULL").drop("again")


def normalize_marketplace(records: DataFrame, details: DataFrame) -> DataFrame:
    """A verified detail sets price and basis, a rate by weight passes, doubtful prices are excluded.

    ``records`` has id, store_id, name, category, size, price, original_price, price_basis,
    pricing_mode and url; ``details`` is keyed by (store_id, id) and free of ``detail_errors``. A
    detail of another page than the record's is a mismatch: the record is excluded with that reason.
    """
    d = details.select(
        "store_id", "id",
        F.struct("url", "pricing_mode", "price_basis", "item_price", "unit_price", "estimated_item_price", "estimated_weight_lb", "source_unit_price", "source_unit").alias("d"),
    )
    joined = records.join(d, ["store_id", "id"], "left")
    found, of = F.col("d").isNotNull(), F.col("d")
    wrong = found & ~of["url"].eqNullSafe(F.col("url"))
    fixed, weighed = found & ~wrong & (of["pricing_mode"] == "fixed_price"), found & ~wrong & (of["pricing_mode"] != "fixed_price")
    by_weight = ~found & (F.lower(_text(F.col("price_basis"))) == "per lb")
    doubtful = unverified_variable_weight(F.col("price_basis"), F.col("pricing_mode"), F.col("size"), F.col("category"), F.col("url"))
    bottle = ambiguous_beverage(F.col("name"), F.col("size"), F.col("price"), F.col("original_price"))
    reason = F.when(wrong, "detail_url_mismatch").when(found | by_weight, "").when(doubtful, "unverified_variable_weight_price").when(bottle, "ambiguous_package_count").otherwise("")
    return joined.select(
        *[c for c in records.columns if c not in ("price", "original_price", "price_basis", "pricing_mode")],
        F.when(found & ~wrong, F.col("price")).alias("raw_price"),
        F.when(fixed, round_half_up(of["item_price"], 2)).when(weighed, round_half_up(of["unit_price"], 2)).otherwise(F.col("price")).alias("price"),
        F.when(~weighed, F.col("original_price")).alias("original_price"),
        F.when(fixed, "per item").when(weighed, "per lb").otherwise(F.col("price_basis")).alias("price_basis"),
        F.when(found & ~wrong, of["pricing_mode"]).when(by_weight, F.coalesce("pricing_mode", F.lit("unit_price_per_lb")))
        .when(doubtful, "unverified_variable_weight").when(bottle, "ambiguous_package_count").otherwise("fixed_price").alias("pricing_mode"),
        F.when(weighed, positive(of["estimated_item_price"])).alias("estimated_item_price"),
        F.when(weighed, positive(of["estimated_weight_lb"])).alias("estimated_weight_lb"),
        F.when(weighed, F.coalesce(of["source_unit_price"], round_half_up(of["unit_price"], 2))).alias("source_unit_price"),
        F.when(weighed, F.coalesce(of["source_unit"], F.lit("lb"))).when(fixed, "").alias("source_unit"),
        (reason == "").alias("eligible"), reason.alias("exclusion_reason"),
    )


def fixed_package_rate(store: Column, source: Column, id_: Column, title: Column, category: Column, size: Column, basis: Column, url: Column) -> Column:
    """A sized package beside which one retailer's card shows a rate by weight for information only (U8)."""
    theirs = (F.lower(_text(store)) == "qfc") | (F.lower(_text(source)) == "qfc.com") | has(_text(url), r"\bqfc\.com\b", True)
    raw = has(_text(category), r"\b(?:meat|seafood)\b", True) & has(_text(title), RAW_MEAT, True) & ~has(_text(title), PREPARED, True) & ~has(_text(title), MEATLESS, True)
    return theirs & (F.lower(_text(basis)) == "per lb") & (F.trim(_text(size)) != "") & ~_text(id_).rlike(RANDOM_WEIGHT_ID) & ~raw


def sold_by_weight(fixed_rate: Column, title: Column, category: Column, size: Column, basis: Column, unit_price: Column) -> Column:
    """U8: whether a direct record's price is one by weight, by its basis or by a parsed rate on a loose good."""
    good = has(_text(title), RAW_MEAT, True) | (~has(_text(title), FIXED_PACKAGE, True) & (has(_text(category), r"\bproduce\b", True) | has(_text(title), LOOSE_PRODUCE, True)))
    return ((F.lower(_text(basis)) == "per lb") & ~fixed_rate) | ((F.trim(_text(size)) == "") & unit_price.isNotNull() & good)


def normalize_direct(records: DataFrame) -> DataFrame:
    """Records of a direct store with rates by weight in place of estimated totals.

    ``records`` has id, store_id, source, title, category, size, price, original_price, price_basis,
    pricing_mode, unit_text and url.
    """
    c = F.col
    made = records.withColumn("_u", parse_unit_text(c("unit_text")))
    made = made.withColumn("_fixed", fixed_package_rate(c("store_id"), c("source"), c("id"), c("title"), c("category"), c("size"), c("price_basis"), c("url")))
    made = made.withColumn("_weight", sold_by_weight(c("_fixed"), c("title"), c("category"), c("size"), c("price_basis"), c("_u.unit_price")))
    bottle = ambiguous_beverage(c("title"), c("size"), c("price"), c("original_price"))
    rated = c("_weight") & c("_u.unit_price").isNotNull()
    kept = c("_weight") & c("_u.unit_price").isNull()
    raw = positive(c("price"))
    estimated = c("_u.estimated_item_price").isNotNull() | F.coalesce(F.abs(raw - c("_u.unit_price")) >= 0.01, F.lit(False))
    return made.select(
        *[x for x in records.columns if x not in ("price", "original_price", "price_basis", "pricing_mode")],
        F.when(rated, c("price")).alias("raw_price"), F.when(rated, c("original_price")).alias("raw_original_price"),
        F.when(rated, c("_u.unit_price")).otherwise(c("price")).alias("price"),
        F.when(~rated, c("original_price")).alias("original_price"),
        F.when(rated, "per lb").when(~c("_weight") & c("_fixed"), "per item").otherwise(c("price_basis")).alias("price_basis"),
        F.when(rated, F.when(estimated, "final_cost_by_weight").otherwise("unit_price_per_lb"))
        .when(kept, F.coalesce("pricing_mode", F.lit("unit_price_per_lb"))).when(bottle, "ambiguous_package_count").otherwise("fixed_price").alias("pricing_mode"),
        F.when(rated & estimated, F.coalesce("_u.estimated_item_price", raw)).alias("estimated_item_price"),
        F.when(rated, c("_u.source_unit_price")).alias("source_unit_price"), F.when(rated, c("_u.source_unit")).alias("source_unit"),
        (c("_weight") | ~bottle).alias("eligible"), F.when(~c("_weight") & bottle, "ambiguous_package_count").otherwise("").alias("exclusion_reason"),
    )


def rebase(records: DataFrame) -> DataFrame:
    """M7: the basis of one retailer's records anew: a rate in the card's text decides, a basis by weight must hold."""
    c = F.col
    rate = has(_text(c("unit_text")), r"/\s*lb\b", True)
    asked = F.when(rate, "per lb").otherwise(c("price_basis"))
    unit = parse_unit_text(c("unit_text"))["unit_price"]
    fixed = fixed_package_rate(c("store_id"), c("source"), c("id"), c("title"), c("category"), c("size"), asked, c("url"))
    weight = sold_by_weight(fixed, c("title"), c("category"), c("size"), asked, unit)
    basis = F.when(rate, F.when(weight, "per lb").otherwise("per item")).when((F.lower(_text(c("price_basis"))) == "per lb") & ~weight, "per item").otherwise(c("price_basis"))
    return records.withColumn("price_basis", F.when(c("store_id") == "qfc", basis).otherwise(c("price_basis")))


def substitute_ids(records: DataFrame, aliases: DataFrame) -> DataFrame:
    """The canonical id of each record where ``aliases`` (id, canonical_id) has one, the captured id kept."""
    named = records.withColumnRenamed("id", "source_id").join(aliases.withColumnRenamed("id", "source_id"), "source_id", "left")
    return named.withColumn("id", F.coalesce("canonical_id", "source_id")).drop("canonical_id")


def matched_observations(records: DataFrame, matches: DataFrame, prefix: str) -> DataFrame:
    """Observations of a store's records under their match's product, or under ``prefix:id``.

    ``records`` as ``normalize_direct`` gives them, ``matches`` (id, product_id, method). A loose meat
    match is by weight, a loose produce match keeps the record's basis, and a packaged match restores
    the captured total.
    """
    c = F.col
    joined = records.join(matches.select("id", "product_id", "method"), "id", "left")
    own = F.coalesce(F.nullif(c("price_basis"), F.lit("")), F.lit("per item"))
    basis = F.when(c("method").isNull() | (c("method") == "normalized_loose_produce_name_basis"), own).when(c("method") == "normalized_loose_meat_name_claims_basis", "per lb").otherwise("per item")
    total = (basis == "per item") & F.coalesce(c("price_basis") == "per lb", F.lit(False)) & positive(c("raw_price")).isNotNull()
    return joined.select(
        F.coalesce("product_id", F.concat(F.lit(f"{prefix}:"), "id")).alias("product_id"), "id", "store_id",
        F.when(total, c("raw_price")).otherwise(c("price")).alias("price"), F.when(total, c("raw_original_price")).otherwise(c("original_price")).alias("original_price"),
        basis.alias("price_basis"),
        F.when(total, "fixed_price").otherwise(F.coalesce(F.nullif(c("pricing_mode"), F.lit("")), F.when(basis == "per lb", "unit_price_per_lb").otherwise("fixed_price"))).alias("pricing_mode"),
        "eligible", "exclusion_reason",
    )
