"""Listings of stores over the star-schema tables, as one SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .binding import spread_out, table

_TITLES = ("chicken thighs", "banana", "orange soda", "apple bag", "cod fillet breaded", "beef steak", "lemon", "vegan beef", "jam", "celery root", "turkey", "ginger ale")
_TITLE = "CASE l_partkey % 12 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TITLES)) + " END"

#: One listing for each order line: every kind of basis, size, card text and address.
LISTINGS = f"""SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber % 3 = 0 THEN concat('002', lpad(CAST(l_partkey AS STRING), 10, '0')) ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS id,
  CASE l_suppkey % 3 WHEN 0 THEN 'qfc' WHEN 1 THEN 'safeway' ELSE 'metro' END AS store_id, 'example.com' AS source,
  concat(p_name, ' ', {_TITLE}) AS title,
  CASE l_partkey % 4 WHEN 0 THEN 'Produce' WHEN 1 THEN 'Meat & Seafood' WHEN 2 THEN 'Deli' ELSE 'Pantry' END AS category,
  CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE '12 fl oz' END AS size,
  floor(l_extendedprice / l_quantity + 0.5) / 100 AS price,
  CASE WHEN l_discount > 0.05 THEN floor(l_extendedprice / l_quantity * 1.25 + 0.5) / 100 END AS original_price,
  CASE l_returnflag WHEN 'A' THEN 'per lb' WHEN 'N' THEN 'per item' ELSE 'Per LB' END AS price_basis, CAST(NULL AS STRING) AS pricing_mode,
  CASE l_suppkey % 5 WHEN 0 THEN '$1.29/lb' WHEN 1 THEN 'price per lb: $2.50, $3.10 each' WHEN 2 THEN '$0.40 per oz' WHEN 3 THEN '$1.99/fl oz' END AS unit_text,
  concat('https://shop.example/products/', CAST(l_partkey AS STRING), CASE l_partkey % 5 WHEN 0 THEN '-item-each' WHEN 1 THEN '-item-per-lb' WHEN 2 THEN '-item-1-lb' WHEN 3 THEN '-item-1-0-lb' ELSE '' END) AS url
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey"""

#: Verified details of some listings, one for each (store, id).
DETAILS = """SELECT store_id, id, min(CASE WHEN l_orderkey % 7 = 0 THEN 'https://shop.example/other' ELSE url END) AS url,
  min(CASE WHEN l_orderkey % 2 = 0 THEN 'fixed_price' ELSE 'final_cost_by_weight' END) AS pricing_mode,
  min(CASE WHEN l_orderkey % 2 = 0 THEN 'per item' ELSE 'per lb' END) AS price_basis,
  min(CASE WHEN l_orderkey % 2 = 0 THEN price * 3 END) AS item_price, min(CASE WHEN l_orderkey % 2 = 1 THEN price / 3 END) AS unit_price,
  min(CASE WHEN l_orderkey % 2 = 1 THEN price END) AS estimated_item_price, min(CASE WHEN l_orderkey % 2 = 1 THEN 3.0 END) AS estimated_weight_lb,
  CAST(NULL AS DOUBLE) AS source_unit_price, CAST(NULL AS STRING) AS source_unit
FROM ({listings}) WHERE l_linenumber = 1 GROUP BY store_id, id"""

#: For DuckDB.
LISTINGS_SQL = LISTINGS.format(lineitem="lineitem", part="part")
DETAILS_SQL = DETAILS.format(listings=LISTINGS_SQL)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LISTINGS, lineitem=spread_out(table(spark, sf_dir, "lineitem")), part=table(spark, sf_dir, "part"))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DETAILS.replace("({listings})", "{listings}"), listings=listings(spark, sf_dir))
