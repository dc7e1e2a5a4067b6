"""Entity views over the TPC-H-like test tables (FIXTURES.md section A).

Each function returns the silver-shaped entity the pipeline expects, derived
lazily from the parquet tables so every query's work grows with them. Only
the referenced columns reach the scan (Catalyst prunes the rest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.money import MONEY

# The category translation used by the fixtures.
CATEGORY_TRANSLATION = [
    ("economy", "economy_en"),
    ("standard", "standard_en"),
    ("medium", "medium_en"),
    ("large", "large_en"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation with its region name (25 rows by the TPC-H definition). No hint:
    Spark broadcasts it from the file-size estimate below the broadcast threshold."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return geo.select("n_nationkey", "n_name", "r_name")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(MONEY)
    freight = F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate")
    days = F.make_dt_interval(days=(F.col("o_orderkey") % 40).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        (ts + F.expr("INTERVAL 1 DAY")).alias("order_approved_at"),
        (ts + F.expr("INTERVAL 2 DAY")).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(ts + days).alias("order_delivered_customer_date"),
        (ts + F.expr("INTERVAL 20 DAY")).alias("order_estimated_delivery_date"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    geo = _geo(spark, sf_dir)
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("u"), (F.col("c_custkey") % 1000).cast("string")).alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.nullif(F.col("r_name"), F.lit("ASIA")).alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    geo = _geo(spark, sf_dir)
    return s.join(geo, s.s_nationkey == geo.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products before category normalisation (raw upper-case type as category)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("product_category_name"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = products_raw(spark, sf_dir)
    return raw.withColumn("product_category_name", F.lower(F.trim("product_category_name")))


def category_translation(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    return spark.createDataFrame(
        CATEGORY_TRANSLATION, "product_category_name string, product_category_name_english string"
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.col("o_orderkey") % 12 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast(MONEY).alias("payment_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("review_id"),
        F.col("event_id").alias("order_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
        .otherwise((F.col("event_id") % 5 + 1).cast("string"))
        .alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    geo = _geo(spark, sf_dir)
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_nationkey").alias("zip"), F.col("n_name").alias("city"), F.col("r_name").alias("state")
    )


ENTITIES = {
    "orders": orders,
    "order_items": order_items,
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "category_translation": category_translation,
    "payments": payments,
    "reviews": reviews,
    "geolocation": geolocation,
}


def write_bronze_csv(spark: SparkSession, sf_dir: str, bronze_root: str) -> dict[str, str]:
    """Write the entity views as raw CSV files (text, header) under ``bronze_root``,
    named like the source files, so the silver job can run on data derived from
    the test tables."""
    from mercato.contracts import ENTITIES as CONTRACTS

    out = {}
    for name, build in ENTITIES.items():
        df = build(spark, sf_dir)
        text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        path = f"{bronze_root.rstrip('/')}/{CONTRACTS[name].file}"
        text.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        out[name] = path
    return out
