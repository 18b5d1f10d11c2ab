"""Queries over whole tables and their operators against brute force."""

import random

from pyspark.sql import functions as F

from shelfwise import queries
from shelfwise.functions import variants
from shelfwise.operators import gate, matching, similarity

FOLDER = "/root/testdata/sf0.001"


def least_labels(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {x: root(x) for x in up}


def test_clusters_on_many_components(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(x, x + 1) for x in range(1000, 1040)] + [(7, 7)]
    got = matching.clusters(spark.createDataFrame(edges, "a long, b long"))
    want = least_labels(edges)
    assert len(set(want.values())) > 20
    assert {r["node"]: r["label"] for r in got.collect()} == want


def test_components_take_every_order_line(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").withColumnRenamed("l_orderkey", "k").select("k", "l_partkey")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumnRenamed("o_orderkey", "k").select("k", "o_custkey")
    edges = [(r["o_custkey"], 100000000 + r["l_partkey"]) for r in lines.join(orders, "k").collect()]
    got = queries.queries()["components_all"](spark, FOLDER).collect()
    assert {r["node"]: r["label"] for r in got} == least_labels(edges)


def test_band_join_at_production_tolerance(spark):
    parts = spark.read.parquet(f"{FOLDER}/part.parquet").select("p_partkey", "p_brand", "p_type", "p_retailprice").collect()
    near = lambda a, b: abs(a - b) <= max(0.08, min(a, b) * 0.025)
    want = {(x[0], y[0]) for x in parts for y in parts if x[0] < y[0] and x[1:3] == y[1:3] and near(x[3] / 10, y[3] / 10)}
    got = [tuple(r) for r in queries.queries()["band_join_all"](spark, FOLDER).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_band_join_over_neighbouring_cells(spark):
    rng = random.Random(12)
    sides = [[(i, "k", rng.choice((0.5, 3.2, 20, 300)) * rng.uniform(0.9, 1.1)) for i in range(150)] for _ in range(2)]
    left, right = (spark.createDataFrame(s, f"{n}_id long, kind string, amount_{n[0]} double") for s, n in zip(sides, ("left", "right")))
    want = {(a[0], b[0]) for a in sides[0] for b in sides[1] if abs(a[2] - b[2]) <= max(0.08, min(a[2], b[2]) * 0.025)}
    got = [tuple(r) for r in matching.band_join(left, right, "kind", "amount").select("left_id", "right_id").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_basket_takes_every_product(spark):
    names = "product_id", "store_id", "price_cents"
    prices = {(r[0], r[1]): r[2] for r in queries.queries()["current_price"](spark, FOLDER).where("eligible").select(*names).collect()}
    basket = {r[0]: min(99, int(r[1] * 2.5)) for r in spark.read.parquet(f"{FOLDER}/part.parquet").select("p_partkey", "p_size").collect()}
    for r in queries.queries()["basket_compare_all"](spark, FOLDER).collect():
        have = [p for p in basket if (p, r["store_id"]) in prices]
        assert r["missing"] == len(basket) - len(have)
        assert r["total_cents"] == sum(prices[p, r["store_id"]] * basket[p] for p in have)


def test_band_pairs_are_all_pairs_and_dealt(spark):
    """Equal amounts, repeated and negative ids, null keys; no side is broadcast, however small its file."""
    rng = random.Random(13)
    rows = [(rng.randrange(-5, 90), rng.choice("kl") if i % 9 else None, rng.choice((0.03, 0.5, 3.2, 20.0, 300.0, -1.0, 0.0)) * rng.choice((1, 1.01, 1.02, 1.03))) for i in range(160)]
    items = spark.createDataFrame(rows, "id long, kind string, a double")
    near = lambda x, y: abs(x - y) <= max(0.08, min(x, y) * 0.025)
    want = sorted((x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and x[1] == y[1] is not None and x[2] > 0 and y[2] > 0 and near(x[2], y[2]))
    assert sorted(tuple(r) for r in matching.band_pairs(items, ["kind"], "id", "a").collect()) == want and len(want) > 300
    plan = queries.queries()["band_join_all"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_similar_pairs_of_many_copies(spark):
    """Word lists are scored once, whatever the number of items that have them."""
    rng = random.Random(14)
    names = ["red bolt", "bolt", "big red bolt", "big blue rod", "blue rod", "", "rod of red bolt ring"]
    rows = [(rng.randrange(60), rng.choice(("b", None)) if i % 5 == 0 else "b", i % 2, " ".join(sorted(rng.choice(names).split()))) for i in range(150)]
    items = spark.createDataFrame(rows, "id long, brand string, size int, w string")

    def score(x, y):
        x, y = set(x.split()), set(y.split())
        return 0.72 * len(x & y) / min(len(x), len(y)) + 0.28 * len(x & y) / len(x | y) if x and y else 0

    want = sorted((x[0], y[0], round(score(x[3], y[3]), 9)) for x in rows for y in rows if x[0] < y[0] and x[1] == y[1] is not None and x[2] == y[2] and score(x[3], y[3]) >= 0.48)
    got = similarity.similar_pairs(items, ["brand", "size"], "id", "w", 0.48).collect()
    assert sorted((r["a"], r["b"], round(r["score"], 9)) for r in got) == want and len(want) > 300


def test_variant_pairs_by_kinds(spark, monkeypatch):
    """Verdicts on kinds, as one table and block by block, are those on the whole texts, contexts that span a pair included."""
    words = ["white", "beans", "deli", "meat sticks", "cheese", "jerky", "soda 6 pack", "soda", "shredded", "finely", "gear", "bolt plate", "milk", "oat", "peanut", "butter cup", "vanilla", "sticks beef", "12 ct", "chicken"]
    rng = random.Random(16)
    rows = [(i % 50, i % 2 or None, " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))) for i in range(90)]
    items = spark.createDataFrame(rows, "id long, z int, v string")
    whole = matching.cut(items.select("id", "z", variants.features(F.col("v")).alias("f")))
    pairs = whole.toDF("left_id", "z", "x").join(whole.toDF("right_id", "z", "y"), "z").where("left_id < right_id")
    want = sorted(tuple(r) for r in pairs.select("left_id", "right_id", ~variants.conflict(F.col("x"), F.col("y"))).collect())
    assert len({x[2] for x in want}) == 2
    for most in (4096, 3):
        monkeypatch.setattr(gate, "KINDS", most)
        assert sorted(tuple(r) for r in gate.variant_pairs(items, ["z"], "id", "v").collect()) == want
    kinds = {r[0] for r in spark.createDataFrame([("gear of milk",), ("bolt, plate milk",), ("milk gear",)], "v string").select(variants.kind(F.col("v"))["text"]).collect()}
    assert kinds == {"zzz milk", "milk zzz"}
