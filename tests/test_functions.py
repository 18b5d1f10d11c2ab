from pyspark.sql import functions as F

import pytest

from shelfwise.functions import claims, commodities, text, units, variants
from shelfwise.operators import crosswalk, explore, matching, merge, normalize, prices


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column.alias("x")).first()["x"]


def test_text(spark):
    assert one(spark, text.plain(F.col("a")), a="Crème™ & Bob’s") == "creme  and  bobs" or one(spark, text.query_key(F.col("a")), a="Crème™ & Bob’s") == "creme and bobs"
    assert one(spark, text.query_key(F.col("a")), a="Crème™ & Bob’s") == "creme and bobs"
    assert one(spark, text.qualifier_text(F.col("a")), a="Bob's ½ Mill") == "bob s 1 2 mill"
    assert one(spark, text.tokens(F.col("a")), a="The Red Beans with 12 oz") == ["red", "bean"]
    assert one(spark, text.tokens_alias(F.col("a")), a="The Red Beans with 12 oz") == ["red", "beans"]
    assert one(spark, text.size_from_title(F.col("a")), a="Juice 12 fl oz, 1.5 L") == "1.5 L"
    assert one(spark, text.size_from_title(F.col("a")), a="Juice") == ""
    assert one(spark, text.url_path(F.col("a")), a="/a/B") == ""
    assert one(spark, text.url_path(F.col("a")), a="https://x.org/A/B?q=1") == "/a/b"


def test_quantities(spark):
    for parser, given, dimension, amount in (
        (units.quantity_direct, "Cola 12 x 16 fl oz", "volume", 192.0),
        (units.quantity_direct, "Cola 4 pack/12 oz", "mass", 48.0),
        (units.quantity_direct, "Eggs 12ct 24 oz", "count", 12.0),
        (units.quantity_direct, "Flour 2 lb bag 5 lb", "mass", 80.0),
        (units.quantity_whole, "Oat milk 32 oz", "volume", 32.0),
        (units.quantity_whole, "Chicken soup 32 oz", "mass", 32.0),
        (units.quantity_whole, "Bars 1.5 oz, pack of 6", "mass", 9.0),
        (units.quantity_alias, "Eggs 12 count 24 oz", "count", 12.0),
        (units.quantity_commodity, "Eggs 1 dozen", "count", 12.0),
    ):
        q = one(spark, parser(F.col("a")), a=given)
        assert (q["dimension"], round(q["amount"], 6)) == (dimension, amount), given
    assert one(spark, units.quantity_direct(F.col("a")), a="Cola") is None


def test_prices(spark):
    assert one(spark, units.price_per_pound(F.col("a"), F.col("u")), a=0.5, u="Oz.") == 8.0
    assert one(spark, units.price_per_pound(F.col("a"), F.col("u")), a=-1.0, u="lb") is None
    d = one(spark, units.parse_detail(F.col("a")), a="Current price: $4.99 / lb\nFinal cost by weight\nAbout 1.5 lb each")
    assert (d["pricing_mode"], d["unit_price"], d["estimated_weight_lb"]) == ("final_cost_by_weight", 4.99, 1.5)
    d = one(spark, units.parse_detail(F.col("a")), a="Current price: $1,204.50")
    assert (d["pricing_mode"], d["price_basis"], d["item_price"]) == ("fixed_price", "per item", 1204.5)
    u = one(spark, units.parse_unit_text(F.col("a")), a="Price per lb: $2.50, $3.10 each")
    assert (u["unit_price"], u["estimated_item_price"]) == (2.5, 3.1)
    assert one(spark, units.ambiguous_beverage(F.col("n"), F.col("s"), F.col("p"), F.lit(None)), n="Orange Soda", s="12 fl oz", p=7.5) is True


def test_claims(spark):
    c = one(spark, claims.claims(F.col("a")), a="Organic Girl salad 90 percent lean, no salt added, boneless")
    assert (c["organic"], c["lean_percent"], c["sodium_state"], c["bone_state"]) == (False, "90", "no salt added", "boneless")
    assert one(spark, claims.house_brand(F.lit("qfc.com"), F.col("a")), a="Kroger Milk") is True
    assert one(spark, claims.house_brand(F.lit("safeway.com"), F.col("a")), a="Kroger Milk") is False


def good(title, category="Pantry", size="", basis="per item", qualifier="", eligible=True):
    return commodities.record(*[F.lit(x) for x in (title, size, category, basis, qualifier, "", eligible)])


def test_loose_goods(spark):
    key = lambda *a, **k: one(spark, commodities.produce_key(good(*a, **k)))
    assert key("Fresh Kroger Bananas, each", "Produce") == "banana" and key("Open Nature Quarters", "Produce") == "open nature quarters"
    assert key("Bananas 2 lb", "Produce") is None and key("Bananas", "Produce", eligible=False) is None and key("Bananas", "Snacks") is None
    cut = lambda *a, **k: one(spark, commodities.meat_key(good(*a, **k)))
    assert cut("Boneless Chicken Thighs", "Meat & Seafood", basis="per lb") == cut("Draper Valley Farms Boneless Chicken Thighs", "Meat & Seafood", basis="Per LB") == "chicken thigh"
    assert cut("Roxy Beef Apples", "Meat", basis="per lb") == "beef apples" and cut("Smoked Salmon", "Seafood", basis="per lb") is None


def judged(spark, make, judge, pairs):
    """``judge`` on the ``make`` column of each pair of records, all made in one table as in the queries."""
    rows = [(i, side, *r) for i, pair in enumerate(pairs) for side, r in enumerate(pair)]
    made = matching.cut(make(spark.createDataFrame(rows, "i int, side int, title string, category string, size string, basis string, qualifier string")))
    a, b = made.where("side = 0").select("i", F.col("made").alias("a")), made.where("side = 1").select("i", F.col("made").alias("b"))
    return [r["x"] for r in a.join(b, "i").select("i", judge(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]


def row(title, category="Pantry", size="", basis="per item", qualifier=""):
    return title, category, size, basis, qualifier


def as_record():
    return commodities.record(*[F.col(c) for c in ("title", "size", "category", "basis", "qualifier")], F.lit(""), F.lit(True))


def test_loose_matches(spark):
    meat = lambda t, q="": row(t, "Meat & Seafood", "", "per lb", q)
    fruit = lambda t, b: row(t, "Produce", "", b)
    make = lambda df: df.select("i", "side", commodities.loose(as_record()).alias("made"))
    got = judged(spark, make, commodities.meat_matches, [
        (meat("Beef Steaks"), meat("Kroger Beef Steak")), (meat("Chicken Wings"), meat("Chicken Wings")), (meat("Chicken Wings", "air chilled"), meat("Chicken Wings", "air chilled")),
        (meat("Chicken Wings", "air chilled"), meat("Chicken Wings", "boneless")),
    ])
    assert got == [True, False, True, False]
    got = judged(spark, make, commodities.produce_matches, [(fruit("Lemons", "per lb"), fruit("Lemon", "per lb")), (fruit("Lemons", "per lb"), fruit("Lemon", "per item"))])
    assert got == [True, False]


def test_staples(spark):
    eggs = row("Organic Large Brown Eggs", size="1 dozen")
    cases = (
        (eggs, row("Kroger Organic Brown Large Eggs", size="12 ct"), ""), (eggs, row("Organic Large Brown Eggs", size="18 ct"), "package_quantity_mismatch"),
        (eggs, row("Large Brown Eggs", size="12 ct"), "protected_claim_mismatch"), (eggs, row("Organic White Eggs", size="12 ct"), "commodity_variant_mismatch"),
        (eggs, row("Butter", size="12 ct"), "commodity_family_mismatch"), (row("Chocolate bar"), eggs, "not_plain_commodity"), (row("Peanut Butter"), eggs, "not_plain_commodity"),
        (row("Chicken Thighs", "Meat & Seafood", basis="per lb"), row("Chicken Thighs", "Meat & Seafood", basis="per lb"), "missing_animal_qualifier_evidence"),
        (row("Beef Steak", "Meat & Seafood", basis="per lb"), row("Beef Ribs", "Meat & Seafood", basis="per lb"), "raw_cut_or_claim_mismatch"),
        (row("Beef Steaks", "Meat & Seafood", basis="per lb"), row("Beef Steak", "Meat & Seafood", basis="per lb"), ""),
        (row("Flour", size="5 lb"), row("Flour", size="5 lb"), "commodity_variant_mismatch"), (row("Strawberries", "Produce", "16 oz"), row("Fresh Strawberry", "produce", "1 lb"), ""),
        (row("Strawberries", "Produce", "16 oz"), row("Lemons", "produce", "1 lb"), "commodity_variant_mismatch"),
    )
    make = lambda df: df.select("i", "side", commodities.staple(as_record()).alias("made"))
    assert judged(spark, make, commodities.staple_match, [c[:2] for c in cases]) == [c[2] for c in cases]


def test_variants(spark):
    fit = (
        ("Salted butter", "Butter"), ("Tofu firm", "Firm tofu"), ("Bars 6 count", "Bars 6 ct"), ("Creamy cheese sauce", "Cheese sauce"), ("Bone", "Plain"), ("Chicken breast gravy", "Chicken thigh gravy"),
        ("Crunchy corn", "Creamy corn"), ("Crème soda 12 ct", "Creme soda 12 count"), ("White Kidney Beans", "Cannellini Beans"),
    )
    clash = (
        ("Salted butter", "Unsalted butter"), ("Tofu firm", "Tofu"), ("Soda 6 pack", "Soda"), ("Soda 6 pack", "Soda 12 pack"), ("Creamy sauce", "Sauce"), ("Bone broth", "Broth"), ("Chicken breast", "Chicken thigh"),
        ("Crunchy peanut butter", "Creamy peanut butter"), ("Green tea mint", "Green tea"), ("Finely shredded cheddar", "Shredded cheddar"), ("Beef jerky cheese sticks", "Beef jerky sticks"), ("Apple juice with calcium", "Apple juice"),
    )
    make = lambda df: df.select("i", "side", variants.features(F.col("title")).alias("made"))
    pairs = [*fit, *clash, *[(b, a) for a, b in clash]]
    got = judged(spark, make, variants.conflict, [(row(a), row(b)) for a, b in pairs])
    assert dict(zip(pairs, got)) == {p: p not in fit for p in pairs}


def test_qualifiers(spark):
    fits = lambda a, b, f: one(spark, f(claims.claims(F.lit(a)), claims.claims(F.lit(b)), claims.about_meat(F.lit(a), F.lit(b))))
    assert fits("Plant-based milk", "Milk", claims.cross_source_compatible) and not fits("Plant-based milk", "Milk", claims.same_source_compatible)
    assert not fits("Boneless ham", "Ham", claims.cross_source_compatible) and not fits("Organic oats", "Oats", claims.cross_source_compatible)


def test_unicode_forms(spark):
    assert one(spark, text.merge_key(F.col("a")), a="  ＡＢＣ ﬁsh ①㎏  Cafe\u0301 ") == "abc fish 1kg café"
    assert one(spark, text.query_key(F.col("a")), a="ＡＢＣ ﬃ Ⅳ №5 ﬁsh") == "abc ffi iv no5 fish"


def test_more_text(spark):
    assert one(spark, text.plain_whole(F.col("a")), a="Unsweetned Milk Macadamia") == "unsweetened milkadamia"
    assert one(spark, text.tokens_whole(F.col("a")), a="The Company Beans your 3.5 oz") == ["bean", "your"]
    assert one(spark, text.brand_tokens(F.col("a")), a="Classic A.1 Sauces Maeve M&M") == ["a1", "sauce", "seattle", "mms"]
    assert one(spark, text.brand_key(F.col("a")), a="The Acme Beans") == "acme" and one(spark, text.brand_key(F.col("a")), a="") == ""
    assert one(spark, text.search_query(F.col("a"), F.col("b")), a="Milk 1 gal", b="1 Gal") == "Milk 1 gal" and one(spark, text.search_query(F.col("a"), F.col("b")), a="Milk", b="1 gal") == "Milk 1 gal"
    assert one(spark, text.url_hints(F.col("a")), a="https://x.org/barista-olive-oil-12-pack") == "barista olive oil 12 count"
    assert one(spark, text.product_text(F.lit(None), F.col("a"), F.col("b")), a="Milk", b="1 l") == "Milk 1 l"
    assert one(spark, text.commodity_text(F.col("a")), a="2% Milk & A2/A2") == "2% milk and a2/a2"


def test_more_units(spark):
    q = lambda d, a: F.struct(F.lit(d).alias("dimension"), F.lit(float(a)).alias("amount"))
    agree = lambda a, b: one(spark, units.quantities_agree(a, b))
    assert agree(q("mass", 100), q("mass", 102.4)) and not agree(q("mass", 100), q("mass", 103)) and not agree(q("count", 12), q("count", 12.01)) and not agree(q("mass", 1), q("volume", 1))
    pick = lambda s, t, z: one(spark, units.arbitrate(F.lit(s), t, z))["amount"]
    assert pick("safeway", q("mass", 10), q("mass", 60)) == 60 and pick("safeway", q("mass", 10), q("mass", 65)) == 10 and pick("qfc", q("mass", 10), q("mass", 65)) == 65
    assert one(spark, units.package_price(F.lit(0.0), F.lit(2.0))) == 2.0 and one(spark, units.package_price(F.lit(3.0), F.lit(2.0))) == 3.0
    assert not one(spark, units.same_retailer_plausible(F.lit(2.0), F.lit(5.5))) and one(spark, units.same_retailer_plausible(F.lit(1.0), F.lit(3.9)))
    assert not one(spark, units.package_plausible(F.lit(1.0), F.lit(None), F.lit(3.3), F.lit(None))) and one(spark, units.package_plausible(F.lit(1.0), F.lit(2.0), F.lit(3.3), F.lit(None)))


def test_patterns_keep_their_matches(spark):
    """Shortened word boundaries against the whole form."""
    import random
    import re

    from shelfwise.functions.regex import _BOUNDARY, java

    rng = random.Random(2)
    patterns = [p for _, p in claims.CATEGORIES] + list(claims.FLAGS.values()) + list(variants.PATTERNS) + [c for _, c, _ in variants.ONE_SIDED] + [r"(?:\bfoo|bar\b)\b", r"\bx\s*|\by", r"\b(\d+)\s*(?:oz|lb)\b"]
    words = sorted({w for p in patterns for w in re.findall("[a-z]{2,}", p)}) + ["é", "_", "1"]
    for _ in range(50):
        t = "".join(rng.choice(words) + rng.choice(["", " ", "-", "s", "."]) for _ in range(rng.randint(1, 6)))
        for p in patterns:
            assert [m.span() for m in re.finditer(p.replace(r"\b", _BOUNDARY), t)] == [m.span() for m in re.finditer(java(p), t)], (p, t)


def test_band_join_is_the_theta_join(spark):
    import random

    rng = random.Random(5)
    a = [(i, "m", rng.choice([rng.uniform(0.01, 5), rng.uniform(1, 400)])) for i in range(400)]
    b = [(i, "m", x * rng.uniform(0.96, 1.04) + rng.uniform(-0.1, 0.1)) for i, (_, _, x) in enumerate(a)]
    got = matching.band_join(spark.createDataFrame(a, "l int, k string, amount_l double"), spark.createDataFrame(b, "r int, k string, amount_r double"), "k", "amount")
    want = {(i, j) for i, _, x in a for j, _, y in b if y > 0 and abs(x - y) <= max(0.08, min(x, y) * 0.025)}
    assert {(r["l"], r["r"]) for r in got.collect()} == want


def test_clusters(spark):
    edges = [(5, 3), (3, 9), (9, 1), (20, 21), (30, 30)] + [(i, i + 1) for i in range(100, 140)]
    got = {r["node"]: r["label"] for r in matching.clusters(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in (1, 3, 5, 9)} == {1} and got[21] == 20 and got[30] == 30 and got[140] == 100


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "", "z"), (3, "c", None)], "k int, v string, w string")
    assert {tuple(r) for r in merge.upsert(old, new, ["k"]).collect()} == {(1, "a", "z"), (2, "b", "y"), (3, "c", None)}
    assert {tuple(r) for r in merge.upsert(old, new, ["k"], True).collect()} == {(1, "", "z"), (2, "b", "y"), (3, "c", None)}
    wide = spark.createDataFrame([(1, "q", 7)], "k int, v string, more int")
    assert {tuple(r) for r in merge.upsert(old, wide, ["k"], True).collect()} == {(1, "q", "x", 7), (2, "b", "y", None)}
    assert one(spark, merge.pad_id(F.col("a")), a="1234567") == "1234567" and one(spark, merge.pad_id(F.col("a")), a="12") == "000012"


def test_merge_captures(spark):
    columns = "id string, title string, category string, price_basis string, ordinal int"
    old = spark.createDataFrame([("000012", "Beef", "Meat & Seafood", "per lb", 0), ("7", "Jam", "Pantry", "per item", 0)], columns)
    new = spark.createDataFrame([("12", "Beef", "Pantry", "per item", 1, "t"), ("12", "Beef steak", "Pantry", "per item", 2, "t"), ("9", "", "Deli", "", 1, "t")], columns + ", target_id string")
    got = {tuple(r) for r in merge.merge_captures(old, new).select("id", "title", "category", "price_basis").collect()}
    assert got == {("000012", "Beef steak", "Meat & Seafood", "per lb"), ("000007", "Jam", "Pantry", "per item"), ("000009", None, "Deli", None)}
    rows = spark.createDataFrame([("a", "m"), ("b", "m"), ("a", None)], "source string, store_id string")
    assert {r["error"] for r in merge.identity_errors(rows, "a", ("m",)).collect()} == {"source", "store"}
    key = lambda **k: one(spark, merge.query_key(*[F.col(c) for c in ("store", "query", "target", "category", "captured")], k.pop("history")), **k)
    assert key(store=" M ", query="Ｏat  Milk", target="", category="c", captured="t", history=False) == "query:m:oat milk" and key(store="m", query="q", target="5", category="c", captured="t", history=True) == "target:5:t"


def test_current_price_without_a_date(spark):
    rows = [(1, "s", None, 5, "b", True, False), (1, "s", "2026-01-01", 9, "b", True, False), (1, "s", "2025-01-01", 1, "b", True, False), (2, "s", None, 3, "b", True, False)]
    obs = spark.createDataFrame(rows, "product_id int, store_id string, observed_at string, price_cents long, price_basis string, eligible boolean, on_sale boolean").withColumn("observed_at", F.to_timestamp("observed_at"))
    assert {r["product_id"]: r["price_cents"] for r in prices.current_prices(obs).collect()} == {1: 9, 2: 3}
    with pytest.raises(ValueError):
        prices.assert_one_basis(obs.withColumn("price_basis", F.col("price_cents").cast("string")))
    prices.assert_one_basis(obs)


def test_detail_errors(spark):
    columns = "id string, store_id string, url string, pricing_mode string, price_basis string, item_price double, unit_price double"
    rows = [
        ("1", "s", "https://x/products/1-a", "fixed_price", "per item", 2.0, None), ("2", "s", "https://x/products/3-a", "unit_price_per_lb", "per lb", None, 2.0), ("4", "s", "u", "odd", "per lb", None, 2.0),
        ("5", "s", "u", "fixed_price", "per lb", 2.0, None), ("6", "s", "u", "unit_price_per_lb", "per lb", None, -1.0), ("", "s", "u", "fixed_price", "per item", 2.0, None),
        ("7", "s", "u", "fixed_price", "per item", 2.0, None), ("7", "s", "u", "fixed_price", "per item", 2.0, None),
    ]
    got = sorted((r["id"], r["error"]) for r in normalize.detail_errors(spark.createDataFrame(rows, columns)).collect())
    assert got == [("", "missing_identity"), ("2", "url_id_mismatch"), ("4", "unsupported_mode"), ("5", "invalid_fixed_price"), ("6", "invalid_per_pound"), ("7", "duplicate_key"), ("7", "duplicate_key")]


def test_numeric_ids_of_any_length(spark):
    ids = ["10", "2", "9", "9" * 25, "1" + "0" * 24, "007", "a", "B"]
    got = [r["i"] for r in spark.createDataFrame([(i,) for i in ids], "i string").orderBy(*explore.numeric_id_order(F.col("i"))).collect()]
    assert got == ["2", "007", "9", "10", "1" + "0" * 24, "9" * 25, "B", "a"]
    names = [r["i"] for r in spark.createDataFrame([("b",), ("Á",), ("a",), ("B",), ("ab",)], "i string").orderBy(*explore.name_order(F.col("i"))).collect()]
    assert names == ["a", "Á", "ab", "b", "B"]


def test_nearest_is_the_best_of_all_pairs(spark):
    import random

    rng = random.Random(9)
    rows = [(i, rng.randrange(3), rng.choice([rng.randrange(2000), 5, 900])) for i in range(200)] + [(900, 7, 1)]
    got = {r["item"]: (r["other"], round(r["score"], 9), round(r["margin"], 9)) for r in matching.nearest_and_margin(spark.createDataFrame(rows, "item long, k int, v long"), ["k"], "item", "v", 2000).collect()}
    want = {}
    for i, k, v in rows:
        best = sorted((abs(v - y), j) for j, q, y in rows if q == k and j != i)
        if best:
            score = 1 - best[0][0] / 2000
            want[i] = (best[0][1], round(score, 9), round((best[1][0] - best[0][0]) / 2000 if len(best) > 1 else score, 9))
    assert got == want


def test_unique_both(spark):
    rows = [("a", "x", 3), ("a", "y", 2), ("b", "x", 2), ("b", "y", 1), ("c", "z", 1)]
    got = matching.unique_both(spark.createDataFrame(rows, "item string, target string, score int"), "item", "target", F.desc("score"))
    assert {(r["item"], r["target"]) for r in got.collect()} == {("a", "x"), ("c", "z")}


ITEM = "id string, store_id string, source string, name string, brand string, size string, category string, price_basis string, price double, original_price double, raw_price double, qualifier string, url string, eligible boolean, captured_query string"


def item(id_, name, size="", price=2.0, category="Pantry", basis="per item", store="m", source="instacart", query=""):
    return (id_, store, source, name, "", size, category, basis, price, None, None, "", "", True, query)


def test_direct_crosswalk(spark):
    """Every stage at which an item can be lost, and every pool."""
    items = [
        item("i1", "Acme Oat Milk", "32 fl oz"), item("i2", "Acme Rolled Oats Jumbo", "18 oz"), item("i3", "Signature Select Beans", "15 oz"), item("i4", "Acme Honey"), item("i5", "Zed Jam", "10 oz"), item("i6", "Lemons", category="Produce"),
        item("i7", "Acme Salted Butter", "8 oz"), item("i8", "Acme Tomato Soup", "11 oz", 1.0), item("i9", "Acme Oat Milk", "32 fl oz"), item("i10", "Red Pasta Shells", "16 oz"), item("i11", "Acme Corn Chips Lime", "9 oz"),
    ]
    records = [
        item("d1", "Acme Oat Milk", "32 fl oz", store="d", source="d"), item("d2", "Acme Rolled Oats", "18 oz", store="d", source="d"), item("d5", "Other Thing", "10 oz", store="d", source="d"), item("d6", "Lemon", category="Produce", store="d", source="d"),
        item("d7", "Acme Unsalted Butter", "8 oz", store="d", source="d"), item("d8", "Acme Tomato Soup", "11 oz", 9.0, store="d", source="d"), item("d10", "Red Pasta Shells", "16 oz", store="d", source="d"),
        item("d11", "Blue Pasta Shells", "16 oz", store="d", source="d"), item("d12", "Acme Corn Chips Lime", "9 oz", store="d", source="d", query="Acme Corn Chips Lime 9 oz"),
    ]
    sides = [crosswalk.describe_direct(spark.createDataFrame(x, ITEM)) for x in (items, records)]
    queries = spark.createDataFrame([("whatever", "i2", ["d2", "zz"]), ("red pasta shells 16 oz", None, ["d10", "d11"])], "query string, target_id string, result_ids array<string>")
    got = {r["item"]: (r["other"], r["method"], r["rejected_at"]) for r in crosswalk.direct_crosswalk(*sides, queries).collect()}
    assert {got.pop("i1"), got.pop("i9")} == {("d1", "normalized_name_size", None), ("d1", "normalized_name_size", "taken")}
    assert got == {
        "i2": ("d2", "targeted_query_name_size", None), "i3": (None, None, "source_exclusive"), "i4": (None, None, "missing_quantity"), "i5": (None, None, "candidate_guards"),
        "i6": ("d6", "normalized_loose_produce_name_basis", None), "i7": (None, None, "candidate_guards"), "i8": (None, None, "candidate_guards"), "i10": ("d10", "exact_query_name_size", None), "i11": ("d12", "exact_query_name_size", None),
    }


def test_brand_named(spark):
    agree = lambda b, n, t="": one(spark, crosswalk.brand_named(F.lit(b), F.lit(n), F.lit(t)))
    assert agree("Acme Farms", "Acme Farm Oats") and not agree("Acme Farms", "Acme Oats") and agree("", "Zed Oats", "Organic Zed Oats") and not agree("", "Oats", "Organic Zed Oats")
    assert one(spark, claims.diet_label(F.lit("gluten-free"))) == "Gluten-free" and one(spark, claims.diet_label(F.lit("all"))) is None


def test_candidate_keys_lose_no_pair(spark):
    """Every pair that passes the brand gate with a score above zero shares a key."""
    import random

    rng = random.Random(15)
    word = lambda: rng.choice(("oat", "milk", "acme", "zed", "jam", "fig", "red", "blue", "corn", "soup"))
    rows = [(i, [word() for _ in range(rng.choice((0, 1, 2, 4)))], [word() for _ in range(rng.randint(1, 13))]) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, brands array<string>, tokens array<string>").withColumn("q", F.struct(F.lit("mass").alias("dimension")))
    made = df.select("id", F.struct("brands", "tokens", "q").alias("x"))
    left, right = ({r["id"]: set(r["k"]) for r in made.select("id", crosswalk._keys(a, b, "x").alias("k")).collect()} for a, b in (("l", "r"), ("r", "l")))
    passed = 0
    for i, a, x in rows:
        for j, b, y in rows:
            shared, least = len(set(x) & set(y)), min(len(set(x)), len(set(y)))
            score = 0.72 * shared / least + 0.28 * shared / len(set(x) | set(y))
            if score >= 0.48 and (not a or not b or a[0] in b or b[0] in a or score >= 0.9):
                passed += 1
                assert left[i] & right[j], (a, x, b, y)
    assert passed > 100


def test_alias_pairs_and_second_pass(spark):
    rows = [item("1", "Acme Oat Milk", "32 fl oz", store="a"), item("2", "Acme Oat Milk", "32 fl oz", store="b"), item("3", "Acme Oat Milk Vanilla", "32 fl oz", store="b"), item("4", "Acme Jam Fig", "8 oz", store="a"), item("5", "Acme Jam Fig", "8 oz", 9.0, store="b")]
    pairs = crosswalk.alias_pairs(crosswalk.describe_aliases(spark.createDataFrame(rows, ITEM)))
    assert {(r["item"], r["other"]) for r in pairs.collect()} == {("1", "2")}
    items = crosswalk.describe_direct(spark.createDataFrame(rows[:1] + rows[3:4], ITEM))
    passed = spark.createDataFrame([("4",)], "item string")
    found = crosswalk.second_pass(items, crosswalk.describe_direct(spark.createDataFrame(rows[1:3], ITEM)), passed)
    assert {(r["item"], r["other"]) for r in found.collect()} == {("1", "2")}
    best = spark.createDataFrame([(1, True, True, 0.6, 0.0), (2, True, False, 0.99, 0.5), (3, False, True, 0.8, 0.1), (4, False, False, 0.8, 0.01), (5, False, False, 0.95, 0.0)], "item int, targeted boolean, in_results boolean, score double, margin double")
    assert {r["item"] for r in crosswalk.targeted_acceptance(best).collect()} == {1, 3, 5}


def copies(names, times, prefix, store, source):
    """Each name as several items, some of another price."""
    return [item(f"{prefix}{i}x{t}", name, "32 fl oz", 2.0 if t % 3 else 9.0, store=store, source=source) for i, name in enumerate(names) for t in range(times)]


def test_copies_are_described_once(spark):
    """Plain items, described by kinds, against items described one by one: copies, two prices, ids of both stores."""
    names = ["Acme Oat Milk", "Acme Oat Milk Vanilla", "Acme Oat Milk Barista"]
    rows = copies(names, 4, "i", "a", "instacart") + copies(names[:2], 4, "i", "b", "instacart") + copies(names[1:], 2, "k", "b", "instacart")
    both = spark.createDataFrame(rows, ITEM)
    one_by_one = crosswalk.alias_pairs(crosswalk.describe_aliases(both)).collect()
    assert sorted(map(tuple, crosswalk.alias_pairs(both, crosswalk.describe_aliases).collect())) == sorted(map(tuple, one_by_one))
    # of an own name and price the least id of the other store that isn't the item's own is the best
    assert {(r["item"], r["other"]) for r in one_by_one} >= {("i0x1", "i0x2")} and len(one_by_one) < len(rows)


def sized(names, sizes, prefix, store, source):
    return [item(f"{prefix}{i}s{z}x{t}", name, f"{z} oz", (2.0, 2.0, 9.0)[t], store=store, source=source) for i, name in enumerate(names) for z in sizes for t in range(3)]


def judgements(monkeypatch):
    """Row counts of the tables that hold pairs with scores but neither items nor cells."""
    seen, write = [], matching.cut

    def cut(df):
        out = write(df)
        if "score" in df.columns and not {"own", "slot", "pool"} & set(df.columns):
            seen.append(out.count())
        return out

    monkeypatch.setattr(matching, "cut", cut)
    return seen


def test_alias_names_are_judged_once(spark, monkeypatch):
    """Names are paired once, whatever their sizes, with the pairs that items described one by one have."""
    names, sizes = ["Acme Oat Milk", "Acme Oat Milk Vanilla", "Acme Black Beans"], range(20, 32)
    both = spark.createDataFrame(sized(names, sizes, "i", "a", "instacart") + sized(names, sizes, "k", "b", "instacart"), ITEM)
    seen = judgements(monkeypatch)
    got = sorted(map(tuple, crosswalk.alias_pairs(both, crosswalk.describe_aliases).collect()))
    assert seen and max(seen) <= len(names) ** 2
    assert got == sorted(map(tuple, crosswalk.alias_pairs(crosswalk.describe_aliases(both)).collect())) and len(got) >= len(names) * len(sizes)


def test_direct_names_are_judged_once(spark, monkeypatch):
    """As above; items with one record of their best name find the runner-up under another name."""
    names, sizes = ["Acme Oat Milk Barista", "Acme Oat Milk Barista Organic Blend", "Acme Black Beans", "Acme Black Beans Whole", "Acme Black Beans Dried"], range(20, 32)
    items = spark.createDataFrame(sized(names[:3], sizes, "i", "m", "instacart"), ITEM)
    rows = [r for r in sized(names, sizes, "d", "d", "d") if r[3] not in names[2:] or r[0].endswith("x0")]
    records, queries = spark.createDataFrame(rows, ITEM), spark.createDataFrame([("acme black beans 20 oz", None, ["d2s20x0", "d4s20x0"])], "query string, target_id string, result_ids array<string>")
    seen = judgements(monkeypatch)
    got = sorted(map(str, crosswalk.direct_crosswalk(items, records, queries, crosswalk.describe_direct).collect()))
    assert seen and max(seen) <= len(names) ** 2
    described = [crosswalk.describe_direct(df) for df in (items, records)]
    found = crosswalk.direct_crosswalk(*described, queries).collect()
    assert got == sorted(map(str, found)) and {r["method"] for r in found} == {"exact_query_name_size", "normalized_name_size"}
    beans = [r for r in found if r["item"] == "i2s25x0"]
    assert beans[0]["other"] == "d2s25x0" and 0 < beans[0]["margin"] < 1  # not the score itself: there is a runner-up


def test_signs_rule_out_no_score(spark):
    import random

    from shelfwise.functions.similarity import may_score, token_score, token_signs

    rng = random.Random(17)
    rows = [(i, [f"t{rng.randrange(rng.choice((5, 400)))}" for _ in range(rng.randint(0, 12))]) for i in range(150)]
    made = spark.createDataFrame(rows, "i int, t array<string>").select("i", "t", token_signs(F.col("t")).alias("s"))
    for least, share in ((0.48, 0.72), (0.82, 0.7)):
        pairs = made.toDF("i", "t", "s").crossJoin(made.toDF("j", "u", "v")).select((token_score(F.col("t"), F.col("u"), share) >= least).alias("is"), may_score(F.col("s"), F.col("v"), least, share).alias("may"))
        counts = {(r["is"], r["may"]): r["count"] for r in pairs.groupBy("is", "may").count().collect()}
        assert (True, False) not in counts and counts[True, True] > 100 and counts[False, False] > 10000


def test_commodity_matches(spark):
    def staples(rows):
        df = spark.createDataFrame(rows, "id string, ordinal int, store_count int, title string, size string, category string")
        none = F.lit(None).cast("string")
        return df.select("*", commodities.staple(commodities.record(F.col("title"), F.col("size"), F.col("category"), F.lit("per lb"), none, none, F.lit(True))).alias("s"))

    left = staples([("t1", 0, 0, "Unsalted Butter", "16 oz", ""), ("t2", 0, 0, "Strawberries", "1 lb", "Produce"), ("t3", 0, 0, "Ground Beef", "", "Meat & Seafood"), ("t4", 0, 0, "Salted Butter", "16 oz", "")])
    groups = staples([("p1", 0, 3, "Kroger Unsalted Butter", "1 lb", ""), ("p2", 0, 2, "Fresh Strawberries", "16 oz", "Produce"), ("p3", 0, 2, "Strawberry", "16 oz", "Produce"), ("p4", 0, 1, "Ground Beef", "", "Meat & Seafood")])
    got = crosswalk.commodity_matches(left.select("id", "s"), groups.select(F.col("id").alias("product_id"), "ordinal", "store_count", "s"))
    assert {(r["item"], r["target"]) for r in got.collect()} == {("t1", "p1"), ("t3", "p4")}  # two targets tie for t2


def test_cluster_summary(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "node int, label int")
    items = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "z")], "id int, name string")
    assert {tuple(r) for r in matching.cluster_summary(labels, items, "id", "name").collect()} == {(1, 2, "abc"), (3, 1, "z")}


def test_upper_median(spark):
    rows = [(i, s, p) for i, (x, y) in enumerate([(1, 0), (2, 0), (3, 0), (4, 0)]) for s, p in (("A", x), ("B", y))]
    current = spark.createDataFrame(rows, "product_id long, store_id string, price_cents long").withColumn("eligible", F.lit(True))
    assert prices.markup_summary(current, "A", "B").first()["median_cents"] == 3


def test_streaming_upsert(spark, tmp_path):
    from shelfwise.streaming.upsert import merge_stream

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in ([(1, "a", 1)], [(1, "", 2), (2, "b", 2)]):
        spark.createDataFrame(batch, "k int, v string, t int").write.mode("append").parquet(src)
        stream = spark.readStream.schema("k int, v string, t int").parquet(src)
        merge_stream(stream, out, ["k"], "t", str(tmp_path / "check")).awaitTermination()
    from shelfwise.sources.catalog import read_table

    assert {(r["k"], r["v"]) for r in read_table(spark, out).collect()} == {(1, "a"), (2, "b")}


def test_captures(spark, tmp_path):
    from shelfwise.sources import catalog

    (tmp_path / "c.json").write_text('{"source": "s", "store": "m", "capturedAt": "2026-01-01T00:00:00Z", "extra": 1, "queries": [{"query": "q", "resultCount": 2, "ids": ["1"]}], "records": [{"id": "1", "name": "n", "price": 1.5, "odd": true}, {"asin": "2", "title": "t"}]}')
    c = catalog.read_captures(spark, str(tmp_path / "c.json"))
    assert [(r["external_id"], r["title"], r["price_basis"]) for r in catalog.records(c).orderBy("ordinal").collect()] == [("1", "n", "per item"), ("2", "t", "per item")]
    assert catalog.query_log(c).first()["result_count"] == 2


def test_sinks(spark, tmp_path):
    """A table's versions, chunks with their manifest, a wide CSV, the load of several tables and a run of stages."""
    import json

    from shelfwise.sources import catalog

    path = str(tmp_path / "t")
    assert catalog.read_table(spark, path) is None
    for n in (3, 5, 2):
        catalog.replace_table(spark.range(n), path)
        assert catalog.read_table(spark, path).count() == n
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]) == 2
    rows = spark.range(25).selectExpr("id", "concat('n', id % 7) AS name")
    listed = catalog.write_chunks(rows, str(tmp_path / "c"), ["name", "id"], 10, title="x")
    assert json.loads((tmp_path / "c" / "_manifest.json").read_text()) == {"title": "x", "chunks": listed} and len(listed) == 3
    want = [(r["id"], r["name"]) for r in rows.orderBy("name", "id").collect()]
    assert [(r["id"], r["name"]) for r in catalog.read_chunks(spark, str(tmp_path / "c")).collect()] == want
    assert catalog.write_chunks(rows.limit(0), str(tmp_path / "e"), ["name", "id"]) == []
    catalog.write_csv(spark.createDataFrame([('a,"b"', None)], "x string, y string").coalesce(1), str(tmp_path / "w"))
    text_ = next(p for p in (tmp_path / "w").iterdir() if p.name.endswith(".csv")).read_text()
    assert text_ == 'x,y\n"a,""b""",\n'
    catalog.load_tables({"p": spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")}, str(tmp_path / "db"), {"p": ["k"]})
    assert {tuple(r) for r in catalog.read_table(spark, str(tmp_path / "db" / "p")).collect()} == {(1, "b"), (2, "c")}
    done = catalog.run_stages(spark, str(tmp_path / "run"), [("one", lambda s, t: s.range(3)), ("two", lambda s, t: t["one"].where("id > 0"))])
    assert done["two"].count() == 2
    with pytest.raises(ZeroDivisionError):
        catalog.run_stages(spark, str(tmp_path / "run"), [("one", lambda s, t: 1 / 0)])
