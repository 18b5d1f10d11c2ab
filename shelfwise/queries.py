"""Registered queries of the catalog engine, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import claims, text, units
from .functions.regex import sql
from .operators import explore, matching, merge, prices, similarity
from .plans.binding import CURRENT, OBS, STORES, observations, spread_out, table
from .registry import QUERIES, SQL, Query, query



def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def _current(spark: SparkSession, d: str) -> DataFrame:
    return prices.current_prices(observations(spark, d))


def _products(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))


_STORE_LIST = ", ".join(f"('{s}', {i})" for i, s in enumerate(STORES))
_WIDE = ", wide AS (SELECT product_id, " + ", ".join(f"min(CASE WHEN store_id = '{s}' THEN price_cents END) AS s{i}" for i, s in enumerate(STORES)) + " FROM cur WHERE eligible GROUP BY product_id)"


# --- prices -------------------------------------------------------------------------------------

@query(f"WITH {CURRENT} SELECT product_id, store_id, observed_at, price_cents, price_basis, eligible, on_sale FROM cur")
def current_price(spark, d):
    """W2, Q4, D7"""
    return _current(spark, d)


@query(f"""WITH {CURRENT}, st(store_id, place) AS (VALUES {_STORE_LIST}), e AS (SELECT * FROM cur WHERE eligible),
p AS (SELECT a.store_id AS store_a, b.store_id AS store_b FROM st a JOIN st b ON a.place < b.place),
j AS (SELECT a.store_id AS store_a, b.store_id AS store_b, a.price_cents AS pa, b.price_cents AS pb FROM e a JOIN e b USING (product_id)),
g AS (SELECT p.store_a, p.store_b, CAST(count(pa) AS BIGINT) AS shared, CAST(coalesce(sum(pa), 0) AS BIGINT) AS total_a, CAST(coalesce(sum(pb), 0) AS BIGINT) AS total_b,
  CAST(count(*) FILTER (pa < pb) AS BIGINT) AS wins_a, CAST(count(*) FILTER (pb < pa) AS BIGINT) AS wins_b, CAST(count(*) FILTER (pa = pb) AS BIGINT) AS ties
  FROM p LEFT JOIN j USING (store_a, store_b) GROUP BY ALL)
SELECT *, CASE WHEN total_a < total_b THEN store_a WHEN total_b < total_a THEN store_b END AS cheaper, abs(total_a - total_b) AS savings_cents,
  floor(CAST(abs(total_a - total_b) AS DOUBLE) / greatest(1, greatest(total_a, total_b)) * 100 * 10.0::DOUBLE + 0.5) / 10.0::DOUBLE AS savings_percent FROM g""")
def pairwise_basket(spark, d):
    """A4, J10"""
    return prices.pairwise_basket(_current(spark, d), STORES)


def _performance_sql(opponents: str) -> str:
    return f"""WITH {CURRENT}, mean AS (SELECT product_id, CAST(sum(price_cents) AS DOUBLE) / count(*) AS m, count(*) AS k FROM cur WHERE eligible GROUP BY product_id),
own AS (SELECT c.*, m, k FROM cur c JOIN mean USING (product_id) WHERE eligible),
g AS (SELECT o.store_id, count(*) FILTER (o.price_cents < x.price_cents) AS wins, count(*) FILTER (o.price_cents > x.price_cents) AS losses, count(*) FILTER (o.price_cents = x.price_cents) AS ties
  FROM own o JOIN cur x ON o.product_id = x.product_id AND o.store_id <> x.store_id {opponents} GROUP BY 1),
i AS (SELECT store_id, count(*) FILTER (k > 1) AS comparable, CAST(sum(CAST(floor(price_cents / m * 1000000 + 0.5) AS BIGINT)) AS DOUBLE) AS ratio, count(*) AS n FROM own GROUP BY 1)
SELECT store_id, CAST(comparable AS BIGINT) AS comparable, CAST(wins AS BIGINT) AS wins, CAST(losses AS BIGINT) AS losses, CAST(ties AS BIGINT) AS ties,
  floor(CAST(wins AS DOUBLE) / greatest(1, wins + losses) * 100 * 10.0::DOUBLE + 0.5) / 10.0::DOUBLE AS win_rate, floor(ratio / n / 1000 + 0.5) / 10.0::DOUBLE AS price_index FROM g JOIN i USING (store_id)"""


@query(_performance_sql(""))
def store_performance(spark, d):
    """A5 with opponents as the reference counts them (A5q)"""
    return prices.store_performance(_current(spark, d), True)


@query(_performance_sql("AND x.eligible"))
def store_performance_eligible(spark, d):
    """A5 against eligible opponents only"""
    return prices.store_performance(_current(spark, d), False)


@query(f"""WITH {CURRENT}, k AS (SELECT product_id, count(*) AS k FROM cur WHERE eligible GROUP BY 1)
SELECT p_type AS category, CAST(count(*) AS BIGINT) AS catalog, CAST(count(*) FILTER (k = 5) AS BIGINT) AS in_all_stores FROM part LEFT JOIN k ON product_id = p_partkey GROUP BY 1""")
def category_rollup(spark, d):
    """A6, E4"""
    return prices.category_rollup(_current(spark, d), _products(spark, d), len(STORES))


@query(f"""WITH {CURRENT}, k AS (SELECT product_id, count(*) AS k FROM cur WHERE eligible GROUP BY 1), c AS (SELECT coalesce(k, 0) AS s, count(*) AS n FROM part LEFT JOIN k ON product_id = p_partkey GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS stores, CAST(coalesce(n, 0) AS BIGINT) AS products FROM range(6) r LEFT JOIN c ON s = r.range""")
def coverage_histogram(spark, d):
    """A7, A14"""
    return prices.coverage_histogram(_current(spark, d), _products(spark, d), len(STORES))


_ELECT = f"""WITH {OBS}, c AS (SELECT product_id, price_basis, count(*) AS n FROM obs WHERE eligible GROUP BY 1, 2),
t AS (SELECT *, rank() OVER (PARTITION BY product_id ORDER BY n DESC) AS r FROM c),
e AS (SELECT product_id, CASE WHEN count(*) = 1 THEN min(price_basis) END AS basis, CAST(min(n) AS BIGINT) AS support FROM t WHERE r = 1 GROUP BY 1)"""


@query(_ELECT + " SELECT * FROM e")
def basis_election(spark, d):
    """A8, Q2"""
    return prices.basis_election(observations(spark, d))


@query(_ELECT + """ SELECT price_basis, CAST(count(*) FILTER (eligible AND coalesce(price_basis = basis, false)) AS BIGINT) AS kept, CAST(count(*) FILTER (eligible AND NOT coalesce(price_basis = basis, false)) AS BIGINT) AS excluded
FROM obs LEFT JOIN e USING (product_id) GROUP BY 1""")
def basis_exclusion(spark, d):
    """Q3, C3 of the load: rows that lose eligibility"""
    out = prices.exclude_other_bases(observations(spark, d))
    return out.groupBy("price_basis").agg(F.count_if("eligible").alias("kept"), F.count_if(F.col("exclusion_reason") != "").alias("excluded"))


@query(f"""WITH {CURRENT}{_WIDE}, m AS (SELECT s0 - s1 AS d FROM wide WHERE s0 IS NOT NULL AND s1 IS NOT NULL)
SELECT CAST(count(*) AS BIGINT) AS products, CAST(count(*) FILTER (d > 0) AS BIGINT) AS dearer, CAST(count(*) FILTER (d < 0) AS BIGINT) AS cheaper, CAST(count(*) FILTER (d = 0) AS BIGINT) AS equal,
CAST(coalesce(sum(d), 0) AS BIGINT) AS total_cents, CAST(coalesce(percentile_disc(0.5) WITHIN GROUP (ORDER BY d DESC), 0) AS BIGINT) AS median_cents FROM m""")
def markup_summary(spark, d):
    """A9, A10"""
    return prices.markup_summary(_current(spark, d), STORES[0], STORES[1])


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events WHERE event_type <> '' GROUP BY 1, 2)
SELECT user_id, event_type, CAST(n AS BIGINT) AS n FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, length(event_type) DESC, f) = 1""")
def most_common_attr(spark, d):
    """A1"""
    return prices.most_common(table(spark, d, "events"), "user_id", "event_type", "event_id")


@query(f"WITH {CURRENT}{_WIDE} SELECT product_id, " + ", ".join(f's{i} AS "{s}"' for i, s in enumerate(STORES)) + " FROM wide")
def pivot_prices(spark, d):
    """A12"""
    return prices.by_product(_current(spark, d), STORES)


@query(f"WITH {OBS} SELECT product_id, CAST(count(DISTINCT price_basis) AS BIGINT) AS bases FROM obs WHERE eligible GROUP BY 1 HAVING count(DISTINCT price_basis) > 1")
def mixed_basis_audit(spark, d):
    """Q8, A15"""
    return prices.mixed_basis(observations(spark, d))


@query(f"""WITH {OBS} SELECT CAST(count(*) FILTER (eligible) AS BIGINT) AS eligible, CAST(count(*) FILTER (NOT eligible) AS BIGINT) AS ineligible, CAST(count(*) FILTER (on_sale AND eligible) AS BIGINT) AS eligible_on_sale,
min(observed_at) AS first_at, max(observed_at) AS last_at, CAST(count(DISTINCT product_id) AS BIGINT) AS products FROM obs""")
def conditional_counts(spark, d):
    """Q5, A3, Q12"""
    return observations(spark, d).agg(
        F.count_if("eligible").alias("eligible"), F.count_if(~F.col("eligible")).alias("ineligible"), F.count_if(F.col("on_sale") & F.col("eligible")).alias("eligible_on_sale"),
        F.min("observed_at").alias("first_at"), F.max("observed_at").alias("last_at"), F.count_distinct("product_id").alias("products"),
    )


@query(f"WITH {OBS} SELECT store_id, price_basis, eligible, CAST(count(*) AS BIGINT) AS n, CAST(sum(price_cents) AS BIGINT) AS cents FROM obs GROUP BY 1, 2, 3")
def group_counts(spark, d):
    """Q6, A22"""
    return observations(spark, d).groupBy("store_id", "price_basis", "eligible").agg(F.count("*").alias("n"), F.sum("price_cents").alias("cents"))


@query("SELECT p_partkey AS product_id FROM part p WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l_linestatus = 'F' AND l_discount > 0.08)")
def anti_unmatched(spark, d):
    """J3, J13, Q10"""
    seen = table(spark, d, "lineitem").where("l_linestatus = 'F' AND l_discount > 0.08").select(F.col("l_partkey").alias("product_id"))
    return _products(spark, d).select("product_id").join(seen, "product_id", "left_anti")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_shared(spark, d):
    """J4"""
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(urgent, "c_custkey", "left_semi")


@query("SELECT p_brand, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND lower(p_name) LIKE '%a%' AND p_brand NOT IN ('Brand#11') GROUP BY 1")
def join_filters(spark, d):
    """J1, Q11"""
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    part = table(spark, d, "part").where("lower(p_name) LIKE '%a%' AND p_brand NOT IN ('Brand#11')").select("p_partkey", "p_brand")
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(done, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("p_brand").agg(F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("suppliers"))


# --- matching -----------------------------------------------------------------------------------

@query("""WITH x AS (SELECT p_partkey AS k, p_brand AS b, p_type AS t, CAST(p_retailprice AS DOUBLE) / 10 AS a FROM part)
SELECT l.k AS left_id, r.k AS right_id FROM x l JOIN x r ON l.b = r.b AND l.t = r.t AND l.k < r.k AND abs(l.a - r.a) <= greatest(0.08::DOUBLE, least(l.a, r.a) * 0.025::DOUBLE) WHERE l.a > 0 AND r.a > 0""")
def band_join_all(spark, d):
    """All pairs of parts of one brand and type within the operator's own tolerance"""
    part = spread_out(table(spark, d, "part")).select("p_partkey", "p_brand", "p_type", (F.col("p_retailprice") / 10).alias("a"))
    return matching.band_pairs(part, ["p_brand", "p_type"], "p_partkey", "a")


@query("""WITH x AS (SELECT p_partkey AS k, p_brand AS b, p_type AS t, floor(p_size * 20 + 0.5) / 20 AS q FROM part)
SELECT b AS brand, t AS kind, q AS amount, CAST(count(*) AS BIGINT) AS members FROM x GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def block_equi(spark, d):
    """Blocks of brand, type and size to a twentieth, and their members"""
    part = table(spark, d, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), (F.floor(F.col("p_size") * 20.0 + 0.5) / 20).alias("amount"))
    return part.groupBy("brand", "kind", "amount").agg(F.count("*").alias("members")).where("members > 1")


_CAND = """cand AS (SELECT l_partkey AS item, CAST(l_suppkey AS VARCHAR) AS other, floor(avg(l_discount) * 1000 + 0.5) / 1000 AS score FROM lineitem GROUP BY 1, 2),
best AS (SELECT item, other, score, floor((score - coalesce(lead(score) OVER w, 0)) * 1000 + 0.5) / 1000 AS margin, row_number() OVER w AS r FROM cand WINDOW w AS (PARTITION BY item ORDER BY score DESC, other))"""


def _candidates(spark, d):
    # discounts are hundredths: sums are exact whole numbers
    line = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("item"), F.col("l_suppkey").cast("string").alias("other"))
    return line.agg(F.avg("l_discount").alias("a")).select("item", "other", (F.floor(F.col("a") * 1000 + 0.5) / 1000).alias("score"))


def _best(spark, d):
    return matching.best_and_margin(_candidates(spark, d), "item", "other").withColumn("margin", F.floor(F.col("margin") * 1000 + 0.5) / 1000)


@query(f"WITH {_CAND} SELECT item, other, score, margin FROM best WHERE r = 1")
def best_and_margin(spark, d):
    """W1"""
    return _best(spark, d)


@query(f"WITH {_CAND}, one AS (SELECT item, other, score, margin, row_number() OVER (PARTITION BY other ORDER BY score DESC, margin DESC, item) AS n FROM best WHERE r = 1) SELECT item, other, score, margin FROM one WHERE n = 1")
def one_to_one(spark, d):
    """W3"""
    return matching.one_to_one(_best(spark, d), "other", F.desc("score"), F.desc("margin"), F.asc("item"))


@query("""WITH c AS (SELECT l_suppkey AS item, l_partkey AS target, count(*) AS strength FROM lineitem GROUP BY 1, 2),
t AS (SELECT *, rank() OVER (PARTITION BY item ORDER BY strength DESC) AS r FROM c), s AS (SELECT item, min(target) AS target, min(strength) AS strength FROM t WHERE r = 1 GROUP BY 1 HAVING count(*) = 1)
SELECT item, target, CAST(strength AS BIGINT) AS strength FROM s QUALIFY count(*) OVER (PARTITION BY target) = 1""")
def strict_unique_assign(spark, d):
    """W5, J12"""
    c = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("item"), F.col("l_partkey").alias("target")).agg(F.count("*").alias("strength"))
    return matching.strict_unique(c, "item", "target", "strength").select("item", "target", "strength")


@query("""WITH x AS (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(floor(c_acctbal * 100 + 0.5) AS BIGINT) AS v FROM customer),
c AS (SELECT a.c_custkey AS item, b.c_custkey AS other, abs(a.v - b.v) AS d FROM x a JOIN x b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey <> b.c_custkey),
b AS (SELECT item, other, 1 - d::DOUBLE / 2000000 AS score, coalesce((lead(d) OVER w - d)::DOUBLE / 2000000, 1 - d::DOUBLE / 2000000) AS margin, row_number() OVER w AS r FROM c WINDOW w AS (PARTITION BY item ORDER BY d, other)),
s AS (SELECT * FROM b WHERE r = 1 AND score >= 0.9 AND (margin >= 0.08 OR score >= 0.98))
SELECT x.item, x.other FROM s x JOIN s y ON x.item = y.other AND x.other = y.item WHERE x.item < x.other""")
def mutual_best(spark, d):
    """W6"""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("item"), "c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") * 100 + 0.5).cast("long").alias("v"))
    return matching.mutual_best(matching.nearest_and_margin(c, ["c_nationkey", "c_mktsegment"], "item", "v", 2000000)).select("item", "other")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, 100000000 + l_partkey AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, label) USING KEY (node) AS (SELECT a, min(least(a, b)) FROM u GROUP BY a
  UNION SELECT u.b, min(r.label) FROM r JOIN u ON u.a = r.node JOIN recurring.r AS c ON c.node = u.b WHERE r.label < c.label GROUP BY u.b)
SELECT node, label FROM r""")
def components_all(spark, d):
    """G1 over every order line"""
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    edges = line.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return matching.clusters(edges.select(F.col("o_custkey").alias("a"), (F.lit(100000000) + F.col("l_partkey")).alias("b")).distinct())


# --- merging ------------------------------------------------------------------------------------

_SPLIT = """old AS (SELECT user_id, event_type, value, props FROM events WHERE ts < TIMESTAMP '2024-01-15' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
new AS (SELECT user_id, event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 2 = 0 THEN '' ELSE props END AS props FROM events WHERE ts >= TIMESTAMP '2024-01-15' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)"""


def _split(spark, d):
    events = table(spark, d, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    old = merge.keep_last(events.where(F.col("ts") < cut), keys, "ts", "event_id").select(*keys, "value", "props")
    last = merge.keep_last(events.where(F.col("ts") >= cut), keys, "ts", "event_id")
    new = last.select(*keys, F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 2 == 0, "").otherwise(F.col("props")).alias("props"))
    return old, new, keys


@query(f"WITH {_SPLIT} SELECT user_id, event_type, coalesce(n.value, o.value) AS value, coalesce(nullif(n.props, ''), o.props) AS props FROM old o FULL JOIN new n USING (user_id, event_type)")
def upsert_nonempty(spark, d):
    """M1"""
    old, new, keys = _split(spark, d)
    return merge.upsert(old, new, keys)


@query(f"WITH {_SPLIT} SELECT user_id, event_type, CASE WHEN n.props IS NOT NULL THEN n.value ELSE o.value END AS value, CASE WHEN n.props IS NOT NULL THEN n.props ELSE o.props END AS props FROM old o FULL JOIN new n USING (user_id, event_type)")
def upsert_replace(spark, d):
    """M5"""
    old, new, keys = _split(spark, d)
    return merge.upsert(old, new, keys, empty_overwrites=True)


@query("SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def dedupe_keep_last(spark, d):
    """P3, Q1"""
    return merge.keep_last(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS \"rows\" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def key_violations(spark, d):
    """Keys that occur more than once, the relational store's constraint"""
    return merge.key_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT 'document' AS kind, doc_id AS id, source, NULL AS url FROM documents UNION ALL SELECT 'page', page_id, NULL, url FROM pages UNION ALL SELECT 'item', item_id, NULL, NULL FROM benchmark")
def union_sources(spark, d):
    """E1"""
    from .sources.catalog import union_sources as union

    return union(
        table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "source", F.lit(None).cast("string").alias("url")),
        table(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "url"),
        table(spark, d, "benchmark").select(F.lit("item").alias("kind"), F.col("item_id").alias("id")),
    )


# --- text, units, claims ------------------------------------------------------------------------

def _cases(rules, subject: str, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({subject}, {sql(p)}) THEN '{n}'" for n, p in rules) + f" ELSE '{default}' END"


@query(f"WITH t AS (SELECT lower(p_name || ' ' || p_type) AS t, p_partkey FROM part UNION ALL SELECT lower(text), -1 - doc_id FROM documents) SELECT p_partkey AS id, {_cases(claims.CATEGORIES, 't', claims.OTHER_CATEGORY)} AS category FROM t")
def classify_first_match(spark, d):
    """C1"""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("n"), F.col("p_type").alias("h"))
    docs = table(spark, d, "documents").select((-1 - F.col("doc_id")).alias("id"), F.col("text").alias("n"), F.lit(None).cast("string").alias("h"))
    return parts.unionByName(spread_out(docs)).select("id", claims.classify(F.col("n"), F.col("h")).alias("category"))


_LEGACY = "CASE " + " ".join(
    f"WHEN regexp_matches(n, {sql(p)}) OR s IN ({', '.join(sql(x) for x in of)}) THEN '{c}'" for c, p, of in claims.LEGACY_CATEGORIES
) + " ELSE 'Pantry' END"


@query(f"WITH t AS (SELECT p_partkey, lower(p_name) AS n, lower(p_type) AS s FROM part) SELECT p_partkey, {_LEGACY} AS category FROM t")
def classify_legacy(spark, d):
    """C2"""
    return table(spark, d, "part").select("p_partkey", claims.classify_legacy(F.col("p_name"), F.col("p_type")).alias("category"))


_DIET = "concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(t, {sql('(?i)' + p)}) THEN '{n}' END" for n, p in claims.DIETS.items()) + ")"
_DIET_TEXT = "p_name || CASE WHEN p_partkey % 3 = 0 THEN ' Gluten-Free' WHEN p_partkey % 3 = 1 THEN ' vegan keto' ELSE '' END || ' ' || CASE WHEN p_partkey % 2 = 0 THEN 'plant based' ELSE '' END"


@query(f"WITH t AS (SELECT p_partkey, {_DIET_TEXT} AS t FROM part) SELECT p_partkey, {_DIET} AS diets FROM t")
def diet_flags(spark, d):
    """C3, C22"""
    part = table(spark, d, "part")
    k = F.col("p_partkey") % 3
    name = F.concat("p_name", F.when(k == 0, " Gluten-Free").when(k == 1, " vegan keto").otherwise(""))
    size = F.when(F.col("p_partkey") % 2 == 0, "plant based").otherwise("")
    return part.select("p_partkey", F.array_join(claims.diet_claims(name, size), ",").alias("diets"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, floor(CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_quantity * 16 ELSE l_quantity / 2.2046226218 END * 100 + 0.5) / 100 AS per_pound,
CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_quantity / 16 ELSE l_quantity * 2.2046226218::DOUBLE END AS pounds FROM lineitem""")
def unit_normalize(spark, d):
    """U1, U2, U23, P7"""
    unit = F.when(F.col("l_returnflag") == "A", " Lbs. ").when(F.col("l_returnflag") == "N", "oz").otherwise("KG")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", units.price_per_pound(F.col("l_quantity"), unit).alias("per_pound"), units.weight_in_pounds(F.col("l_quantity"), unit).alias("pounds"))


_QTY_TEXT = "p_name || CASE p_partkey % 5 WHEN 0 THEN ' 12 x ' || p_size || ' fl oz' WHEN 1 THEN ' 4 pack/' || p_size || ' oz' WHEN 2 THEN ' ' || p_size || ' ct' WHEN 3 THEN ' ' || p_size || '.5 kg bag' ELSE '' END"


_AMOUNTS = "floor(CASE p_partkey % 5 WHEN 0 THEN 12 * p_size WHEN 1 THEN {} * p_size WHEN 2 THEN p_size WHEN 3 THEN (p_size + 0.5::DOUBLE) * 1000 / 28.349523125::DOUBLE END * 1000 + 0.5) / 1000"


@query(f"""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'volume' WHEN 1 THEN 'mass' WHEN 2 THEN 'count' WHEN 3 THEN 'mass' END AS dimension,
{_AMOUNTS.format(4)} AS direct, {_AMOUNTS.format(4)} AS whole, {_AMOUNTS.format(4)} AS alias, {_AMOUNTS.format(1)} AS commodity FROM part""")
def quantity_parse(spark, d):
    """The four parsers"""
    t = F.expr(_QTY_TEXT)
    parsers = {"direct": units.quantity_direct, "whole": units.quantity_whole, "alias": units.quantity_alias, "commodity": units.quantity_commodity}
    q = table(spark, d, "part").select("p_partkey", t.alias("t")).select("p_partkey", *[f(F.col("t")).alias(n) for n, f in parsers.items()])
    return q.select("p_partkey", F.col("direct.dimension").alias("dimension"), *[(F.floor(F.col(f"{n}.amount") * 1000 + 0.5) / 1000).alias(n) for n in parsers])


@query("SELECT p_partkey, concat_ws(',', CAST(p_size AS VARCHAR), CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) END) AS numbers FROM part")
def numeric_variant(spark, d):
    """U20"""
    t = F.concat(F.lit("No. 1 brand type "), F.col("p_size"), F.lit(" 100% 12 oz pack of 6 "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("string")).otherwise(F.lit("")))
    return table(spark, d, "part").select("p_partkey", F.array_join(claims.leftover_numbers(t), ",").alias("numbers"))


_PLAIN = "regexp_replace(replace(replace(replace(lower(strip_accents(text)), '&', ' and '), '''', ''), '’', ''), '[^a-z0-9]+', ' ', 'g')"


_QUALIFIER = "trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g'), ' ')"


@query(f"SELECT doc_id, md5(trim(coalesce({_PLAIN}, ''), ' ')) AS key_md5, CAST(length(trim(coalesce({_PLAIN}, ''), ' ')) AS INTEGER) AS length, md5({_QUALIFIER}) AS qualifier_md5 FROM documents")
def text_normalize(spark, d):
    """Search keys and qualifier texts of whole texts"""
    docs = spread_out(table(spark, d, "documents")).select("doc_id", text.query_key(F.col("text")).alias("key"), text.qualifier_text(F.col("text")).alias("q"))
    return docs.select("doc_id", F.md5(F.col("key").cast("binary")).alias("key_md5"), F.length("key").alias("length"), F.md5(F.col("q").cast("binary")).alias("qualifier_md5"))


@query("SELECT page_id, lower(coalesce(nullif(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), ''), '')) AS path FROM pages")
def url_path(spark, d):
    """T16"""
    return table(spark, d, "pages").select("page_id", text.url_path(F.col("url")).alias("path"))


@query("SELECT event_id, strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%d') AS local_date FROM events")
def local_date(spark, d):
    """T18"""
    return table(spark, d, "events").select("event_id", text.local_date(F.col("ts").cast("timestamp")).alias("local_date"))


@query("""WITH t AS (SELECT p_partkey, p_brand, p_size, list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) > 1)) AS w FROM part),
j AS (SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(a.w, b.w)) AS i, least(len(a.w), len(b.w)) AS m, len(list_distinct(list_concat(a.w, b.w))) AS u FROM t a JOIN t b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
SELECT a, b, floor((0.72::DOUBLE * i / m + 0.28::DOUBLE * i / u) * 1000 + 0.5) / 1000 AS score FROM j WHERE m > 0 AND 0.72::DOUBLE * i / m + 0.28::DOUBLE * i / u >= 0.48""")
def token_similarity(spark, d):
    """E2, F1, F3's least score"""
    words = F.filter(F.split(text.words_only(F.lower(F.col("p_name"))), " "), lambda w: F.length(w) > 1)
    rows = spread_out(table(spark, d, "part")).select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.concat_ws(" ", F.array_sort(F.array_distinct(words))).alias("w"))
    return similarity.similar_pairs(rows, ["brand", "size"], "p_partkey", "w", 0.48).select("a", "b", (F.floor(F.col("score") * 1000 + 0.5) / 1000).alias("score"))


# --- exploring ----------------------------------------------------------------------------------

_SPREAD = ", ".join(f"s{i}" for i in range(5))


@query(f"""WITH {CURRENT}{_WIDE}, x AS (SELECT product_id, p_name AS name, p_type AS category, list_filter([{_SPREAD}], lambda v: v IS NOT NULL) AS v FROM wide JOIN part ON p_partkey = product_id)
SELECT product_id, name, category, list_min(v) AS lowest, list_max(v) - list_min(v) AS spread_cents FROM x WHERE len(v) >= 2 AND contains(lower(name || ' ' || category), 'a') ORDER BY spread_cents DESC, name, product_id LIMIT 48""")
def explore_filter_sort(spark, d):
    """P10, P11, O3, O6"""
    p = _products(spark, d).withColumn("size", F.lit(None).cast("string")).withColumn("on_sale", F.lit(False))
    return explore.explore(p, _current(spark, d), STORES, search="a")


@query(f"""WITH {CURRENT}{_WIDE}, u AS (SELECT product_id, unnest([{', '.join(f"{{'s': '{s}', 'p': s{i}}}" for i, s in enumerate(STORES))}]) AS x FROM wide), e AS (SELECT product_id, x.s AS s, x.p AS p FROM u WHERE x.p IS NOT NULL),
m AS (SELECT product_id, min(p) AS lo, max(p) AS hi, count(*) AS n FROM e GROUP BY 1)
SELECT product_id, CAST(n AS BIGINT) AS stores, hi - lo AS spread_cents, (SELECT string_agg(s, ',' ORDER BY s) FROM e WHERE e.product_id = m.product_id AND e.p = m.lo) AS lowest_stores FROM m""")
def spread_lowest(spark, d):
    """B5"""
    return prices.spread(_current(spark, d))


@query(f"""WITH {CURRENT}{_WIDE}, b AS (SELECT p_partkey AS product_id, least(99, floor(p_size * 2.5)) AS q FROM part WHERE p_size > 0),
st(store_id, place) AS (VALUES {_STORE_LIST}), x AS (SELECT store_id, place, q, CASE place {' '.join(f'WHEN {i} THEN s{i}' for i in range(5))} END AS p FROM b CROSS JOIN st LEFT JOIN wide USING (product_id)),
g AS (SELECT store_id, place, CAST(coalesce(sum(p * q), 0) AS BIGINT) AS total_cents, CAST(count(*) FILTER (p IS NULL) AS BIGINT) AS missing FROM x GROUP BY 1, 2)
SELECT store_id, total_cents, missing, missing = 0 AS complete, CAST(row_number() OVER (ORDER BY missing, total_cents, place) AS INTEGER) AS rank FROM g""")
def basket_compare_all(spark, d):
    """A basket of all products"""
    p = _products(spark, d)
    basket = p.select("product_id", (F.col("size") * 2.5).alias("quantity"))
    return prices.compare_basket(prices.sanitize_basket(basket, p), _current(spark, d), STORES)


@query(f"""WITH {CURRENT}, k AS (SELECT product_id, count(*) AS k FROM cur WHERE eligible GROUP BY 1)
SELECT product_id, CAST(k * 100 + CASE WHEN p_size % 2 = 0 THEN 0 ELSE 25 END + CASE WHEN p_type LIKE '%A%' THEN 5 ELSE 0 END AS BIGINT) AS priority FROM k JOIN part ON p_partkey = product_id ORDER BY priority DESC, product_id LIMIT 40""")
def frontier_topk(spark, d):
    """G3, O3"""
    k = _current(spark, d).where("eligible").groupBy("product_id").agg(F.count("*").alias("k"))
    items = k.join(_products(spark, d), "product_id")
    return explore.frontier(items, F.col("k"), F.col("size") % 2 == 0, F.col("category").like("%A%"))


@query(f"""WITH {CURRENT}{_WIDE} SELECT product_id, concat_ws(',', {', '.join(f"CASE WHEN s{i} IS NULL THEN '{s}' END" for i, s in enumerate(STORES))}) AS missing FROM wide WHERE {' + '.join(f'(s{i} IS NULL)::INT' for i in range(5))} = 1""")
def missing_store(spark, d):
    """G4, E3"""
    return explore.missing_stores(prices.by_product(_current(spark, d), STORES), STORES, 4)


@query(f"""WITH {CURRENT}{_WIDE}, x AS (SELECT product_id, list_filter([{', '.join(f"CASE WHEN s{i} IS NULL THEN '{s}' END" for i, s in enumerate(STORES))}], lambda v: v IS NOT NULL) AS g FROM wide)
SELECT product_id, g[1] AS next_store, CAST((4 - len(g)) * 1000 + 105 AS BIGINT) AS priority FROM x WHERE len(g) BETWEEN 1 AND 4""")
def core_gaps(spark, d):
    """G5"""
    return explore.core_gaps(prices.by_product(_current(spark, d), STORES), STORES)


@query("SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS position, CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 5000) AS BIGINT) AS chunk FROM orders")
def chunk_assign(spark, d):
    """S5"""
    return explore.chunks(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 5000).select("o_orderkey", "position", "chunk")


@query("SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY length(CAST(c_custkey AS VARCHAR)), CAST(c_custkey AS VARCHAR)) AS INTEGER) AS place FROM customer")
def numeric_id_sort(spark, d):
    """O2, M3"""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return explore.place_in_group(c, "c_nationkey", explore.numeric_id_order(F.col("c_custkey").cast("string"))).select("c_custkey", "place")


# --- more of the explorer, baskets and audits ---------------------------------------------------

_STRICT = " AND ".join(f"s{i} IS NOT NULL" for i in range(len(STORES)))
_LEAST = "list_min([" + ", ".join(f"{{'t': sum(s{i}), 'i': {i}, 's': '{s}'}}" for i, s in enumerate(STORES)) + "]).s"


@query(f"""WITH {CURRENT}{_WIDE} SELECT p_type AS category, CAST(count(*) AS BIGINT) AS products, {', '.join(f'CAST(sum(s{i}) AS BIGINT) AS "{s}"' for i, s in enumerate(STORES))}, {_LEAST} AS leader
FROM wide JOIN part ON p_partkey = product_id WHERE {_STRICT} GROUP BY 1""")
def category_breakdown(spark, d):
    """A17, P9"""
    return prices.category_breakdown(_current(spark, d), _products(spark, d), STORES)


@query(f"""WITH {CURRENT}{_WIDE}, t AS (SELECT unnest([{', '.join(f"{{'store_id': '{s}', 'place': {i}, 'total_cents': CAST(coalesce(sum(s{i}), 0) AS BIGINT)}}" for i, s in enumerate(STORES))}]) AS x FROM wide WHERE {_STRICT})
SELECT x.store_id AS store_id, x.total_cents AS total_cents, CAST(row_number() OVER (ORDER BY x.total_cents, x.place) AS INTEGER) AS rank, CAST(max(x.total_cents) OVER () - min(x.total_cents) OVER () AS BIGINT) AS saving_cents FROM t""")
def snapshot_baskets(spark, d):
    """A18"""
    return prices.snapshot_baskets(_current(spark, d), STORES)


@query(f"""WITH {CURRENT}{_WIDE} SELECT CAST(least({', '.join(f'count(*) FILTER (s{i} IS NOT NULL AND s{j} IS NOT NULL)' for i in range(5) for j in range(i + 1, 5))}) AS BIGINT) AS least_shared FROM wide""")
def least_pair(spark, d):
    """A19"""
    return prices.least_pair(prices.pairwise_basket(_current(spark, d), STORES))


@query(f"WITH t AS (SELECT {_DIET_TEXT} AS t FROM part) SELECT " + ", ".join(f"CAST(count(*) FILTER (regexp_matches(t, {sql('(?i)' + p)})) AS BIGINT) AS {n.replace('-', '_')}" for n, p in claims.DIETS.items()) + " FROM t")
def claim_counts(spark, d):
    """A20"""
    k = F.col("p_partkey") % 3
    name = F.concat("p_name", F.when(k == 0, " Gluten-Free").when(k == 1, " vegan keto").otherwise(""))
    return explore.claim_counts(table(spark, d, "part").select(name.alias("name"), F.when(F.col("p_partkey") % 2 == 0, "plant based").otherwise("").alias("size")))


@query(f"""WITH {CURRENT}, b AS (SELECT product_id, price_basis, list_sort(list(DISTINCT store_id)) AS st FROM cur WHERE eligible GROUP BY 1, 2)
SELECT product_id, price_basis AS basis, list_aggregate(st, 'string_agg', ',') AS stores, CAST(count(*) OVER (PARTITION BY product_id) AS BIGINT) AS bases FROM b
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY len(st) DESC, price_basis) = 1""")
def dominant_basis(spark, d):
    """A16, W9"""
    return prices.dominant_basis(_current(spark, d))


@query(f"""WITH {CURRENT}{_WIDE}, g AS (SELECT p_type AS category, count(*) AS n, sum(s0) AS a, sum(s1) AS b, count(*) FILTER (s0 < s1) AS wa, count(*) FILTER (s1 < s0) AS wb, count(*) FILTER (s0 = s1) AS t
  FROM wide JOIN part ON p_partkey = product_id WHERE s0 IS NOT NULL AND s1 IS NOT NULL GROUP BY 1)
SELECT category, CAST(n AS BIGINT) AS products, CAST(a AS BIGINT) AS total_a, CAST(b AS BIGINT) AS total_b, CAST(wa AS BIGINT) AS wins_a, CAST(wb AS BIGINT) AS wins_b, CAST(t AS BIGINT) AS ties, CAST(b - a AS BIGINT) AS difference_cents,
  floor(CAST(b - a AS DOUBLE) / CAST(b AS DOUBLE) * 1000 + 0.5) / 10 AS difference_percent, CASE WHEN b > a THEN '{STORES[0]}' WHEN b < a THEN '{STORES[1]}' ELSE 'Tie' END AS winner FROM g""")
def category_duel(spark, d):
    """A13, A10"""
    return prices.category_duel(prices.by_product(_current(spark, d), STORES), _products(spark, d), STORES[0], STORES[1])


@query("SELECT p_brand, p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS INTEGER) AS place FROM part QUALIFY place <= 8")
def top_of_group(spark, d):
    """O1, O4"""
    part = table(spark, d, "part").select("p_brand", "p_partkey", "p_name")
    return explore.top_of_group(part, "p_brand", [*explore.name_order(F.col("p_name")), F.col("p_partkey")], 8).select("p_brand", "p_partkey", "place")


@query("""WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS k, CAST(l_partkey AS VARCHAR) AS id, CAST(l_partkey % 500 AS VARCHAR) AS canonical_id, CAST(l_suppkey % 4 AS VARCHAR) AS store_id, l_linestatus = 'F' AS eligible,
  CASE WHEN l_partkey % 2 = 0 THEN 'Produce' ELSE 'Pantry' END AS category, CASE WHEN l_discount > 0.05 THEN 'unverified_variable_weight_price' ELSE 'ambiguous_package_count' END AS reason FROM lineitem),
u AS (SELECT DISTINCT id, canonical_id, store_id, category, reason FROM r WHERE NOT eligible),
c AS (SELECT canonical_id, count(DISTINCT store_id) FILTER (eligible) AS e, count(DISTINCT store_id) AS a FROM r GROUP BY 1), s AS (SELECT id, count(DISTINCT store_id) AS n FROM r GROUP BY 1)
SELECT store_id, id, canonical_id, reason AS exclusion_reason, CAST(e * 100 + n * 30 + a * 10 + CASE WHEN category = 'Produce' THEN 20 ELSE 0 END + CASE WHEN reason LIKE 'unv%' THEN 10 ELSE 0 END AS BIGINT) AS priority
FROM u JOIN c USING (canonical_id) JOIN s USING (id) ORDER BY priority DESC, length(canonical_id), canonical_id, store_id, id LIMIT 40""")
def unresolved(spark, d):
    """G6, O3"""
    line = table(spark, d, "lineitem")
    records = line.select(
        F.col("l_partkey").cast("string").alias("id"), (F.col("l_partkey") % 500).cast("string").alias("canonical_id"), (F.col("l_suppkey") % 4).cast("string").alias("store_id"), (F.col("l_linestatus") == "F").alias("eligible"),
        F.when(F.col("l_partkey") % 2 == 0, "Produce").otherwise("Pantry").alias("category"), F.when(F.col("l_discount") > 0.05, "unverified_variable_weight_price").otherwise("ambiguous_package_count").alias("exclusion_reason"),
    ).distinct()
    return explore.unresolved(records).withColumn("priority", F.col("priority").cast("long"))


@query(f"""WITH {CURRENT}, o AS (SELECT product_id, price_cents AS lowest FROM cur WHERE store_id = '{STORES[2]}')
SELECT product_id, p_name AS name, p_type AS category, lowest, CAST(0 AS BIGINT) AS spread_cents FROM o JOIN part ON p_partkey = product_id ORDER BY lowest, name, product_id LIMIT 48 OFFSET 10""")
def explore_one_store(spark, d):
    """One store's products, eligible or not, the second page"""
    p = _products(spark, d).withColumn("size", F.lit(None).cast("string")).withColumn("on_sale", F.lit(False))
    return explore.explore(p, _current(spark, d), STORES, (STORES[2],), sort="price", offset=10).withColumn("spread_cents", F.col("spread_cents").cast("long"))


@query(f"""WITH {CURRENT}{_WIDE}, x AS (SELECT product_id, p_name AS name, p_type AS category, [{_SPREAD}] AS v, s0 FROM wide JOIN part ON p_partkey = product_id WHERE {_STRICT} AND p_size > 25 AND p_type = 'PROMO')
SELECT product_id, name, category, list_min(v) AS lowest, list_max(v) - list_min(v) AS spread_cents FROM x WHERE s0 = list_min(v) AND len(list_filter(v, lambda p: p = list_min(v))) = 1 ORDER BY name, product_id""")
def explore_winner(spark, d):
    """A category's vegan goods on sale that all stores have and one sells cheapest"""
    p = _products(spark, d).withColumn("on_sale", F.col("size") > 25).withColumn("size", F.lit("vegan"))
    return explore.explore(p, _current(spark, d), STORES, STORES, True, category="PROMO", diet="vegan", winner=STORES[0], sale_only=True, sort="name", limit=None)


_BASKET = f"""b AS (SELECT p_partkey AS product_id, least(99, floor(p_size * 2.5)) AS q FROM part WHERE p_size = 7), st(store_id, place) AS (VALUES {_STORE_LIST}),
x AS (SELECT store_id, place, product_id, q, CASE place {' '.join(f'WHEN {i} THEN s{i}' for i in range(5))} END AS p FROM b CROSS JOIN st LEFT JOIN wide USING (product_id))"""


@query(f"WITH {CURRENT}{_WIDE}, {_BASKET} SELECT store_id, coalesce(list_aggregate(list_sort(list(product_id) FILTER (p IS NULL)), 'string_agg', ','), '') AS missing, CAST(coalesce(sum(p * q), 0) AS BIGINT) AS total_cents FROM x GROUP BY 1")
def basket_missing(spark, d):
    """B2: a shopper's basket, the products of one size, with what each store lacks"""
    p = _products(spark, d)
    basket = p.where("size = 7").select("product_id", (F.col("size") * 2.5).alias("quantity"))
    return prices.compare_basket(prices.sanitize_basket(basket, p), _current(spark, d), STORES, True).select("store_id", F.array_join("missing_ids", ",").alias("missing"), "total_cents")


@query(f"""WITH {CURRENT}{_WIDE}, g AS (SELECT y.s AS store_id, sum(y.p) AS t FROM (SELECT unnest([{', '.join(f"{{'s': '{s}', 'p': s{i}}}" for i, s in enumerate(STORES))}]) AS y FROM wide WHERE {_STRICT}) GROUP BY 1), m AS (SELECT min(t) AS c FROM g)
SELECT CAST(c AS BIGINT) AS cheapest, string_agg(store_id, ',' ORDER BY store_id) FILTER (t = c) AS stores, CAST(min(t) FILTER (t > c) - c AS BIGINT) AS saving_cents FROM g, m GROUP BY c""")
def basket_verdict(spark, d):
    """One of each product that every store prices"""
    cur = _current(spark, d)
    basket = prices.strict_common(cur, STORES).select("product_id", F.lit(1).alias("quantity"))
    return prices.basket_verdict(prices.compare_basket(basket, cur, STORES))


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY length(o_orderpriority) DESC, o_orderdate, o_orderkey) = 1")
def keep_first(spark, d):
    """The longest, then the first"""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return merge.keep_first(o, ["o_custkey"], -F.length("o_orderpriority"), F.col("o_orderdate"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderpriority")


@query(f"""WITH {OBS} SELECT store_id, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT product_id) AS BIGINT) AS products FROM obs JOIN part ON p_partkey = product_id
WHERE eligible AND store_id IN ('ASIA', 'EUROPE') AND price_cents > 0 AND (lower(p_name) LIKE '%bolt%' OR lower(p_name) LIKE '%widget%') GROUP BY 1""")
def filtered_counts(spark, d):
    """Q7, Q9, Q10's and Q12's LIKE, P1, P4"""
    o = observations(spark, d).where("eligible").where(F.col("store_id").isin("ASIA", "EUROPE") & units.positive(F.col("price_cents")).isNotNull())
    named = table(spark, d, "part").where("lower(p_name) LIKE '%bolt%' OR lower(p_name) LIKE '%widget%'").select(F.col("p_partkey").alias("product_id"))
    return o.join(named, "product_id").groupBy("store_id").agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("products"))


@query(f"""WITH {CURRENT}, c AS (SELECT product_id, {', '.join(f"max(price_cents) FILTER (store_id = '{s}') AS p{i}, max(price_basis) FILTER (store_id = '{s}') AS b{i}" for i, s in enumerate(STORES))}, count(*) AS n, count(*) FILTER (eligible) AS e FROM cur GROUP BY 1)
SELECT p_partkey AS canonical_product_id, p_name AS product, CAST(coalesce(n, 0) AS BIGINT) AS stores_available, CAST(coalesce(e, 0) AS BIGINT) AS stores_comparable,
  {', '.join(f'p{i} AS "{s}_price", b{i} AS "{s}_price_basis"' for i, s in enumerate(STORES))} FROM part LEFT JOIN c ON p_partkey = product_id""")
def wide_products(spark, d):
    """S7, P8, A12"""
    from .sources.catalog import wide_products as wide

    none = F.lit(None).cast("string")
    cur = _current(spark, d).select(
        "product_id", "store_id", F.col("price_cents").alias("price"), none.alias("original_price"), F.col("on_sale").alias("sale"), none.alias("source"), "price_basis", F.col("eligible").alias("comparison_eligible"),
        none.alias("exclusion_reason"), none.alias("catalog_url"),
    )
    p = _products(spark, d).select(F.col("product_id").alias("canonical_product_id"), F.col("name").alias("product"), "size", "category", none.alias("price_basis"), none.alias("local_image"), none.alias("source_image_url"))
    return wide(p, cur, STORES).select("canonical_product_id", "product", "stores_available", "stores_comparable", *[f"{s}_{c}" for s in STORES for c in ("price", "price_basis")])


from . import record_queries  # noqa: E402, F401  registers its queries
