"""The catalog entities over the star-schema tables: stores are regions, products are parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_out(df: DataFrame) -> DataFrame:
    """A scan dealt over all cores if its files are too few to give each one work; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() * 2 <= cores else df


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per price observation. Line items are the large side; suppliers' stores are joined to them."""
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey"), F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("observed_at"),
        F.floor(F.try_divide("l_extendedprice", "l_quantity") * 100 + 0.5).cast("long").alias("price_cents"),
        F.col("l_returnflag").alias("price_basis"), (F.col("l_linestatus") == "F").alias("eligible"), (F.col("l_discount") > 0).alias("on_sale"),
    )
    stores = (
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("store_id")), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "store_id")
    )
    return line.join(stores, F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey").where("price_cents IS NOT NULL")


#: The same for DuckDB.
OBS = """obs AS (
  SELECT l_partkey AS product_id, l_shipdate AS observed_at, CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) AS BIGINT) AS price_cents,
    l_returnflag AS price_basis, l_linestatus = 'F' AS eligible, l_discount > 0 AS on_sale, r_name AS store_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CURRENT = OBS + """, cur AS (
  SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY product_id, store_id
    ORDER BY eligible DESC, observed_at DESC, price_cents, price_basis, on_sale) = 1)"""
