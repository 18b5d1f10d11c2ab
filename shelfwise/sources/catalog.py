"""Capture files in, published tables out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = (
    "id string, storeId string, asin string, brand string, name string, title string, size string, detailSize string, category string, "
    "price double, originalPrice double, sale boolean, priceBasis string, unitText string, qualifierText string, productUrl string, "
    "imageUrl string, capturedAt string, capturedUrl string, query string, source string"
)
QUERY = "storeId string, query string, category string, capturedAt string, count int, resultCount int, ids array<string>, asins array<string>, targetProductId string"
CAPTURE = f"source string, store string, capturedAt string, queries array<struct<{QUERY.replace(' string', ':string').replace(' int', ':int').replace(' array', ':array')}>>, records array<struct<{RECORD.replace(' string', ':string').replace(' double', ':double').replace(' boolean', ':boolean')}>>"


def read_captures(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per capture file; unknown keys are dropped."""
    return spark.read.option("multiLine", True).schema(CAPTURE).json(list(paths))


def records(captures: DataFrame) -> DataFrame:
    """One row per record in one shape, with its place in the file."""
    r = captures.select(F.col("source").alias("file_source"), F.col("store").alias("file_store"), F.posexplode("records").alias("ordinal", "r"))
    return r.select(
        F.coalesce("r.source", "file_source").alias("source"), F.coalesce("r.storeId", "file_store").alias("store_id"),
        F.coalesce("r.id", "r.asin").alias("external_id"), F.coalesce("r.title", "r.name").alias("title"), F.col("r.brand").alias("brand"),
        F.coalesce(F.nullif(F.col("r.size"), F.lit("")), "r.detailSize", F.lit("")).alias("size"), F.col("r.category").alias("category"),
        F.col("r.price").alias("price"), F.col("r.originalPrice").alias("original_price"), F.coalesce("r.sale", F.lit(False)).alias("on_sale"),
        F.coalesce("r.priceBasis", F.lit("per item")).alias("price_basis"), F.col("r.unitText").alias("unit_text"), F.col("r.qualifierText").alias("qualifier_text"),
        F.col("r.productUrl").alias("product_url"), F.to_timestamp("r.capturedAt").alias("observed_at"), F.col("r.query").alias("query"), "ordinal",
    )


def query_log(captures: DataFrame) -> DataFrame:
    """D3: one row per captured query."""
    q = captures.select(F.col("store").alias("file_store"), F.explode("queries").alias("q"))
    return q.select(
        F.coalesce("q.storeId", "file_store").alias("store_id"), F.col("q.query").alias("query"), F.col("q.category").alias("category"),
        F.to_timestamp("q.capturedAt").alias("captured_at"), F.coalesce("q.count", "q.resultCount", F.lit(0)).alias("result_count"),
        F.coalesce("q.ids", "q.asins").alias("result_ids"), F.col("q.targetProductId").alias("target_id"),
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """By name; columns that a source lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: Columns of the wide table before its stores', and what each store has.
WIDE_FIXED = ("canonical_product_id", "product", "size", "category", "price_basis", "stores_available", "stores_comparable", "local_image", "source_image_url")
WIDE_STORE = ("price", "original_price", "sale", "source", "price_basis", "comparison_eligible", "exclusion_reason", "catalog_url")


def wide_products(products: DataFrame, current: DataFrame, stores: tuple[str, ...]) -> DataFrame:
    """A row for each product, the fixed columns and eight for each store; null where a store lacks it.

    ``products`` has the fixed columns but the two counts, ``current`` (product_id, store_id and
    ``WIDE_STORE``), one row for each product and store.
    """
    of = F.struct(*WIDE_STORE)
    pivoted = current.groupBy("product_id").agg(
        F.count("*").alias("stores_available"), F.count_if("comparison_eligible").alias("stores_comparable"),
        *[F.min(F.when(F.col("store_id") == s, of)).alias(f"_{i}") for i, s in enumerate(stores)],
    )
    joined = products.join(pivoted.withColumnRenamed("product_id", "canonical_product_id"), "canonical_product_id", "left").fillna(0, ["stores_available", "stores_comparable"])
    return joined.select(*WIDE_FIXED, *[F.col(f"_{i}.{c}").alias(f"{s}_{c}") for i, s in enumerate(stores) for c in WIDE_STORE])


def write_csv(df: DataFrame, path: str) -> None:
    """Header, quotes where needed and doubled inside, nulls empty."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(path)


def write_chunks(df: DataFrame, path: str, order: list[str], rows: int = 5000, **metadata) -> list[str]:
    """JSON files by chunk, numbered in the global order, and a manifest that lists them beside ``metadata``."""
    from ..operators.explore import chunks

    made = chunks(df, order, rows)
    made.repartition("chunk").sortWithinPartitions("chunk", "position").write.mode("overwrite").partitionBy("chunk").json(path)
    numbers = made.agg(F.max("chunk").alias("last")).first()["last"]
    listed = [f"chunk={n}" for n in range(0 if numbers is None else numbers + 1)]
    write_json(df.sparkSession, f"{path.rstrip('/')}/_manifest.json", {**metadata, "chunks": listed})
    return listed


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunks in the manifest's order."""
    read = spark.read.json(path)
    return read.orderBy("chunk", "position").drop("chunk", "position")


def _fs(spark: SparkSession, path: str):
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    return to, to.getFileSystem(spark._jsc.hadoopConfiguration())


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """One small JSON document, indented, replaced in one step."""
    _write_text(spark, path, json.dumps(value, indent=2, default=str) + "\n")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark._jvm
    staged, fs = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    overwrite = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(overwrite, 1)
    options[0] = overwrite.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(staged, jvm.org.apache.hadoop.fs.Path(path), options)


def _read_text(spark: SparkSession, path: str) -> str | None:
    to, fs = _fs(spark, path)
    if not fs.exists(to):
        return None
    stream = fs.open(to)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_table(df: DataFrame, path: str) -> None:
    """A new version beside the others, then a pointer to it is replaced in one step.

    A crash leaves the old version current; the version before the last is kept for open readers.
    """
    spark = df.sparkSession
    base, before = path.rstrip("/"), _read_text(df.sparkSession, f"{path.rstrip('/')}/_current")
    version = f"v{int((before or 'v0-').split('-')[0][1:]) + 1}-{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{version}")
    _write_text(spark, f"{base}/_current", version)
    folder, fs = _fs(spark, base)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v") and name not in (version, before):
            fs.delete(status.getPath(), True)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """S3: the current version of a table that ``replace_table`` wrote; None before the first."""
    version = _read_text(spark, f"{path.rstrip('/')}/_current")
    return None if version is None else spark.read.parquet(f"{path.rstrip('/')}/{version}")


def load_tables(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]]) -> None:
    """The relational load: of rows that repeat a table's key one is kept, then each table is replaced.

    ``keys`` names each table's key; rows of one key are told apart by all their columns, the last stays.
    """
    from ..operators.merge import keep_last

    for name, df in tables.items():
        rest = [c for c in df.columns if c not in keys[name]]
        replace_table(keep_last(df, keys[name], *rest) if rest else df.distinct(), f"{path.rstrip('/')}/{name}")


def run_stages(spark: SparkSession, path: str, stages: list[tuple[str, Callable[[SparkSession, dict[str, DataFrame]], DataFrame]]]) -> dict[str, DataFrame]:
    """Stages in order, each given the tables of those before it and written before the next; an error ends the run."""
    done: dict[str, DataFrame] = {}
    for name, stage in stages:
        replace_table(stage(spark, done), f"{path.rstrip('/')}/{name}")
        done[name] = read_table(spark, f"{path.rstrip('/')}/{name}")
    return done
