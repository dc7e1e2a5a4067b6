"""Seller analytics by readable seller label (city, state)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import resolve_column
from mercato.functions.money import money_sum_or_zero
from mercato.operators.shape import top_n
from mercato.plans.labels import add_seller_labels

# Candidate metric columns.
REVENUE_CANDIDATES = ("seller_revenue", "revenue", "total_revenue", "sales")
UNITS_CANDIDATES = ("items_sold", "units_sold", "item_count")


def seller_sales_fallback(fact_order_items: DataFrame) -> DataFrame:
    """Per seller from items when the seller mart is missing: rows and price sum
    (0 when the price column is absent)."""
    price = resolve_column(fact_order_items, ["price", "product_price"], strict=True)
    revenue = money_sum_or_zero(price).alias("seller_revenue") if price else F.lit(0).alias("seller_revenue")
    return (
        fact_order_items.filter(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(F.count(F.lit(1)).alias("items_sold"), revenue)
    )


def seller_sales(sales_by_seller: DataFrame | None, fact_order_items: DataFrame) -> DataFrame:
    return sales_by_seller if sales_by_seller is not None else seller_sales_fallback(fact_order_items)


def _by_label(sales: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    revenue = resolve_column(sales, REVENUE_CANDIDATES, strict=True)
    units = resolve_column(sales, UNITS_CANDIDATES, strict=True)
    labelled = add_seller_labels(sales, dim_sellers)
    aggs = []
    if revenue:
        aggs.append(F.sum(revenue).alias("seller_revenue"))
    if units:
        aggs.append(F.sum(units).alias("items_sold"))
    return labelled.filter(F.col("seller_label").isNotNull()).groupBy("seller_label").agg(*aggs)


def top_sellers_by_revenue(sales: DataFrame, dim_sellers: DataFrame, n: int = 15) -> DataFrame:
    out = _by_label(sales, dim_sellers).select("seller_label", "seller_revenue")
    return top_n(out, "seller_revenue", "seller_label", n)


def top_sellers_by_items(sales: DataFrame, dim_sellers: DataFrame, n: int = 15) -> DataFrame:
    out = _by_label(sales, dim_sellers).select("seller_label", "items_sold")
    return top_n(out, "items_sold", "seller_label", n)


def seller_performance(sales: DataFrame, dim_sellers: DataFrame, n: int = 25) -> DataFrame:
    out = _by_label(sales, dim_sellers)
    metric = "seller_revenue" if "seller_revenue" in out.columns else "items_sold"
    return top_n(out, metric, "seller_label", n)


def seller_order_volume(fact_order_items: DataFrame) -> DataFrame:
    """Distinct orders per seller (the distinct form of ``orders_handled``)."""
    out = (
        fact_order_items.filter(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(F.countDistinct("order_id").alias("orders"))
    )
    return out.orderBy(F.col("orders").desc(), F.col("seller_id").asc())
