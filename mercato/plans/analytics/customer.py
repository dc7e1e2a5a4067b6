"""Customer analytics: active customers, revenue by state / city, purchase frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.money import money_sum_or_zero
from mercato.operators.clean import dedupe_by_key
from mercato.operators.shape import top_n


def _per_customer(fact_orders: DataFrame) -> DataFrame:
    """Orders reduced to one row per customer before any join (map-side combine)."""
    return fact_orders.groupBy("customer_id").agg(
        F.sum("total_order_value").alias("_revenue"),
        F.countDistinct("order_id").alias("_orders"),
    )


def _orders_with_customers(fact_orders: DataFrame, dim_customers: DataFrame, cols: list[str]) -> DataFrame:
    """Per-customer order totals left-joined to the customer rows (a customer id
    listed twice counts twice, like the dashboard's merge)."""
    cust = dim_customers.select("customer_id", *cols)
    return _per_customer(fact_orders).join(cust, "customer_id", "left")


def customer_kpis(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    merged = _orders_with_customers(fact_orders, dim_customers, ["customer_state"])
    row = merged.agg(
        F.countDistinct("customer_id").alias("active_customers"),
        money_sum_or_zero("_revenue").alias("customer_revenue"),
    )
    avg = F.when(
        F.col("active_customers") > 0, F.col("customer_revenue").cast("double") / F.col("active_customers")
    ).otherwise(F.lit(0.0))
    return row.select("active_customers", "customer_revenue", avg.alias("avg_customer_value"))


def revenue_by_state(fact_orders: DataFrame, dim_customers: DataFrame, n: int = 15) -> DataFrame:
    merged = _orders_with_customers(fact_orders, dim_customers, ["customer_state"])
    out = (
        merged.filter(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(money_sum_or_zero("_revenue").alias("revenue"))
    )
    return top_n(out, "revenue", "customer_state", n)


def customers_by_city(dim_customers: DataFrame, n: int = 20) -> DataFrame:
    out = (
        dim_customers.filter(F.col("customer_city").isNotNull())
        .groupBy("customer_city")
        .agg(F.countDistinct("customer_id").alias("customers"))
    )
    return top_n(out, "customers", "customer_city", n)


#: Which of a customer's rows survives: the smallest by these columns.
SURVIVOR_ORDER = ("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state")


def customer_lookup(dim_customers: DataFrame, cols: list[str]) -> DataFrame:
    """One row per customer id, so joins never fan out. The survivor is the smallest whole row, whatever
    ``cols`` are: a customer listed twice has city and state of one and the same row in every query."""
    rows = dim_customers.select("customer_id", *[c for c in SURVIVOR_ORDER if c in dim_customers.columns or c in cols])
    return dedupe_by_key(rows, ["customer_id"]).select("customer_id", *cols)


def _located(fact_orders: DataFrame, dim_customers: DataFrame, col: str) -> DataFrame:
    per = _per_customer(fact_orders)
    return per.join(customer_lookup(dim_customers, [col]), "customer_id", "left").filter(F.col(col).isNotNull())


def revenue_by_city(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    out = _located(fact_orders, dim_customers, "customer_city").groupBy("customer_city").agg(
        money_sum_or_zero("_revenue").alias("revenue")
    )
    return out.orderBy(F.col("revenue").desc(), F.col("customer_city").asc())


def orders_by_city(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Orders per city; an order belongs to one customer, so per-customer distinct
    counts add up exactly."""
    out = _located(fact_orders, dim_customers, "customer_city").groupBy("customer_city").agg(
        F.sum("_orders").alias("orders")
    )
    return out.orderBy(F.col("orders").desc(), F.col("customer_city").asc())


def orders_per_customer(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Histogram of orders placed per unique customer (repeat-purchase profile)."""
    per = _per_customer(fact_orders).join(
        customer_lookup(dim_customers, ["customer_unique_id"]), "customer_id", "inner"
    )
    per_person = per.groupBy("customer_unique_id").agg(F.sum("_orders").alias("orders_placed"))
    hist = per_person.groupBy("orders_placed").agg(F.count(F.lit(1)).alias("customers"))
    return hist.orderBy("orders_placed")


def customer_value_by_location(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    located = _located(fact_orders, dim_customers, "customer_state")
    agg = located.groupBy("customer_state").agg(
        F.countDistinct("customer_id").alias("customers"),
        money_sum_or_zero("_revenue").alias("revenue"),
    )
    avg = F.when(F.col("customers") > 0, F.col("revenue").cast("double") / F.col("customers"))
    out = agg.select("customer_state", "customers", "revenue", avg.alias("avg_customer_value"))
    return out.orderBy(F.col("avg_customer_value").desc_nulls_last(), F.col("customer_state").asc())
