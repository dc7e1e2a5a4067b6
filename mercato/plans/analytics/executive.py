"""Executive overview: headline KPIs, monthly revenue, order status, insights."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import resolve_column, to_datetime, to_number
from mercato.functions.formatting import format_count, format_money
from mercato.functions.money import MONEY, money_sum_or_zero
from mercato.operators.shape import fill_month_gaps, month_end_ts, month_start, one_row, top_n
from mercato.plans.labels import add_product_labels

# Candidate column names used by the overview.
REVENUE_CANDIDATES = ("total_order_value", "order_value", "revenue", "total_price")
DATE_CANDIDATES = ("order_purchase_timestamp", "purchase_timestamp", "order_date")
STATUS_CANDIDATES = ("order_status", "status")
PRICE_CANDIDATES = ("price", "product_price")
# Insight sentences.
PRODUCT_INSIGHT = ("Top revenue-driving product category: **", "**.")
CITY_INSIGHT = ("Largest customer concentration is in **", "**.")


def _money(df: DataFrame, col: str | None):
    """Numeric money column (decimal kept exact; text coerced)."""
    if col is None:
        return F.lit(None).cast(MONEY)
    dtype = df.schema[col].dataType.simpleString()
    return F.col(col) if dtype.startswith("decimal") else to_number(col).cast(MONEY)


def order_kpis(fact_orders: DataFrame) -> DataFrame:
    revenue_col = resolve_column(fact_orders, REVENUE_CANDIDATES, strict=True)
    oid = resolve_column(fact_orders, ["order_id"], strict=True)
    orders = F.countDistinct(oid) if oid else F.count(F.lit(1))
    return fact_orders.agg(
        money_sum_or_zero(_money(fact_orders, revenue_col)).alias("revenue"), orders.alias("orders")
    )


def customer_count(dim_customers: DataFrame) -> DataFrame:
    cid = resolve_column(dim_customers, ["customer_id"], strict=True)
    n = F.countDistinct(cid) if cid else F.lit(0).cast("bigint")
    return dim_customers.agg(n.alias("customers"))


def item_counts(fact_order_items: DataFrame) -> DataFrame:
    """``item_records`` = rows; ``distinct_item_seq`` = distinct item sequence numbers
    (what the overview card showed)."""
    seq = resolve_column(fact_order_items, ["order_item_id", "item_id"], strict=True)
    distinct_seq = F.countDistinct(F.col(seq).cast("string")) if seq else F.count(F.lit(1))
    return fact_order_items.agg(F.count(F.lit(1)).alias("item_records"), distinct_seq.alias("distinct_item_seq"))


def executive_kpis(fact_orders: DataFrame, fact_order_items: DataFrame, dim_customers: DataFrame) -> DataFrame:
    row = one_row(order_kpis(fact_orders), customer_count(dim_customers), item_counts(fact_order_items))
    aov = F.when(F.col("orders") > 0, F.col("revenue").cast("double") / F.col("orders")).otherwise(F.lit(0.0))
    return row.select(
        "revenue", "orders", "customers", "item_records", "distinct_item_seq", aov.alias("average_order_value")
    )


def executive_kpi_cards(kpis: DataFrame) -> DataFrame:
    """The five overview cards as display text."""
    return kpis.select(
        format_money("revenue").alias("revenue_text"),
        format_count("orders").alias("orders_text"),
        format_count("customers").alias("customers_text"),
        format_count("distinct_item_seq").alias("items_text"),
        format_money("average_order_value").alias("average_order_text"),
    )


def item_order_consistency(kpis: DataFrame) -> DataFrame:
    """Flag when fewer item sequence numbers than orders are seen (the overview caption)."""
    item_count = F.col("distinct_item_seq")
    order_count = F.col("orders")
    return kpis.select(
        item_count.alias("item_count"),
        order_count.alias("order_count"),
        ((item_count > 0) & (item_count < order_count)).alias("items_below_orders"),
    )


def monthly_revenue(fact_orders: DataFrame) -> DataFrame:
    """Revenue per calendar month, empty months as 0, labelled by month end."""
    date_col = resolve_column(fact_orders, DATE_CANDIDATES, strict=True)
    revenue_col = resolve_column(fact_orders, REVENUE_CANDIDATES, strict=True)
    ts = F.col(date_col) if fact_orders.schema[date_col].dataType.simpleString().startswith("timestamp") else (
        to_datetime(date_col)
    )
    monthly = (
        fact_orders.select(ts.alias("_ts"), _money(fact_orders, revenue_col).alias("_v"))
        .filter(F.col("_ts").isNotNull())
        .groupBy(month_start("_ts").alias("_month"))
        .agg(money_sum_or_zero("_v").alias("revenue"))
    )
    filled = fill_month_gaps(monthly, "_month", {"revenue": 0})
    return filled.select(month_end_ts("_month").alias("month"), "revenue").orderBy("month")


def order_status_mix(fact_orders: DataFrame, ascending: bool = False) -> DataFrame:
    status = resolve_column(fact_orders, STATUS_CANDIDATES, strict=True)
    counts = fact_orders.groupBy(F.coalesce(F.col(status), F.lit("unknown")).alias("order_status")).agg(
        F.count(F.lit(1)).alias("count")
    )
    order = F.col("count").asc() if ascending else F.col("count").desc()
    return counts.orderBy(order, F.col("order_status").asc())


def product_revenue_by_label(fact_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Per product label: units (rows with a product id) and revenue (sum of price).

    Items are reduced to one row per product before labels are joined on, so
    the label join runs at product grain.
    """
    price = resolve_column(fact_order_items, PRICE_CANDIDATES, strict=True)
    per_product = (
        fact_order_items.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count("product_id").alias("_units"), F.sum(_money(fact_order_items, price)).alias("_revenue"))
    )
    labelled = add_product_labels(per_product, dim_products)
    return (
        labelled.filter(F.col("product_label").isNotNull())
        .groupBy("product_label")
        .agg(F.sum("_units").alias("units_sold"), money_sum_or_zero("_revenue").alias("revenue"))
    )


def top_revenue_label(fact_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    return top_n(product_revenue_by_label(fact_order_items, dim_products), "revenue", "product_label", 1)


def top_customer_city(dim_customers: DataFrame) -> DataFrame:
    city = resolve_column(dim_customers, ["customer_city", "city"], strict=True)
    cid = resolve_column(dim_customers, ["customer_id"], strict=True)
    counts = (
        dim_customers.filter(F.col(city).isNotNull())
        .groupBy(F.col(city).alias("customer_city"))
        .agg(F.countDistinct(cid).alias("customers"))
    )
    return top_n(counts, "customers", "customer_city", 1)


def business_insights(top_label: DataFrame | None, top_city: DataFrame | None) -> DataFrame:
    """Zero to two sentences: the top product label, then the top customer city; ``None`` leaves one out."""
    parts = []
    if top_label is not None:
        parts.append(top_label.select(
            F.concat(F.lit(PRODUCT_INSIGHT[0]), F.col("product_label"), F.lit(PRODUCT_INSIGHT[1])).alias("insight")
        ))
    if top_city is not None:
        parts.append(top_city.select(
            F.concat(F.lit(CITY_INSIGHT[0]), F.col("customer_city"), F.lit(CITY_INSIGHT[1])).alias("insight")
        ))
    return reduce(DataFrame.unionByName, parts)
