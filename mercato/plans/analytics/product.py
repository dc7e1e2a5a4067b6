"""Product analytics: top products by units / revenue, category performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import resolve_column
from mercato.functions.money import avg_cents_half_up, money_avg, money_sum_or_zero
from mercato.operators.clean import dedupe_by_key
from mercato.operators.shape import top_n
from mercato.plans.labels import PRODUCT_CATEGORY_CANDIDATES, add_product_labels

# Candidate metric columns.
UNITS_CANDIDATES = ("units_sold", "item_count", "items_sold")
REVENUE_CANDIDATES = ("product_revenue", "revenue", "total_revenue", "sales")


def product_sales_fallback(fact_order_items: DataFrame) -> DataFrame:
    """Per product from items, used when the product mart is missing: units = rows,
    revenue = sum of price (0 when no price)."""
    return (
        fact_order_items.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("units_sold"), money_sum_or_zero("price").alias("product_revenue"))
    )


def product_sales(sales_by_product: DataFrame | None, fact_order_items: DataFrame) -> DataFrame:
    return sales_by_product if sales_by_product is not None else product_sales_fallback(fact_order_items)


def _by_label(sales: DataFrame, dim_products: DataFrame, metric: str) -> DataFrame:
    labelled = add_product_labels(sales, dim_products)
    return (
        labelled.filter(F.col("product_label").isNotNull())
        .groupBy("product_label")
        .agg(F.sum(metric).alias(metric))
    )


def top_products_by_units(sales: DataFrame, dim_products: DataFrame, n: int = 15) -> DataFrame:
    units = resolve_column(sales, UNITS_CANDIDATES, strict=True)
    out = _by_label(sales, dim_products, units).withColumnRenamed(units, "units_sold")
    return top_n(out, "units_sold", "product_label", n)


def top_products_by_revenue(sales: DataFrame, dim_products: DataFrame, n: int = 15) -> DataFrame:
    revenue = resolve_column(sales, REVENUE_CANDIDATES, strict=True)
    out = _by_label(sales, dim_products, revenue).withColumnRenamed(revenue, "product_revenue")
    return top_n(out, "product_revenue", "product_label", n)


def product_category_lookup(dim_products: DataFrame) -> DataFrame:
    """``product_id, category`` (English name first); one row per product."""
    cat = resolve_column(dim_products, PRODUCT_CATEGORY_CANDIDATES, strict=True)
    lookup = dim_products.select("product_id", F.col(cat).alias("category"))
    return dedupe_by_key(lookup, ["product_id"])


def category_performance(sales: DataFrame, dim_products: DataFrame, n: int = 20) -> DataFrame:
    """Units and revenue per category (NULL category dropped), top ``n`` by revenue."""
    units = resolve_column(sales, UNITS_CANDIDATES, strict=True)
    revenue = resolve_column(sales, REVENUE_CANDIDATES, strict=True)
    joined = sales.join(product_category_lookup(dim_products), "product_id", "left")
    aggs = []
    if units:
        aggs.append(F.sum(units).alias("units_sold"))
    if revenue:
        aggs.append(F.sum(revenue).alias("revenue"))
    out = joined.filter(F.col("category").isNotNull()).groupBy("category").agg(*aggs)
    return top_n(out, "revenue" if revenue else "units_sold", "category", n)


def low_sales_products(dim_products: DataFrame, sales: DataFrame, n: int = 20) -> DataFrame:
    """Bottom ``n`` products by units, never-sold products counted as 0."""
    units = resolve_column(sales, UNITS_CANDIDATES, strict=True)
    per = sales.select("product_id", F.col(units).alias("_units"))
    out = dim_products.select("product_id").distinct().join(per, "product_id", "left")
    out = out.select("product_id", F.coalesce("_units", F.lit(0)).cast("bigint").alias("units_sold"))
    return top_n(out, "units_sold", "product_id", n, ascending=True)


def category_order_volume(fact_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Distinct orders and half-up average item price per category.

    Items are first reduced to (product, order) pairs, then categorised.
    """
    pairs = fact_order_items.groupBy("product_id", "order_id").agg(
        F.sum("price").alias("_revenue"), F.count("price").alias("_priced")
    )
    joined = pairs.join(product_category_lookup(dim_products), "product_id", "inner")
    agg = (
        joined.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            F.sum("_revenue").alias("_revenue"),
            F.sum("_priced").alias("_priced"),
        )
    )
    average = avg_cents_half_up(F.col("_revenue") * 100, F.col("_priced"))
    out = agg.select("category", "orders", average.alias("average_price"))
    return out.orderBy(F.col("orders").desc(), F.col("category").asc())


def average_product_price(fact_order_items: DataFrame) -> DataFrame:
    """Average item price over all priced items (half-up to the cent)."""
    return fact_order_items.agg(
        F.count("price").alias("priced_items"), money_avg("price").alias("average_price")
    )
