"""Delivery and logistics: freight KPIs, lateness, freight share by order value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.money import MONEY, exact_mean, money_sum_or_zero
from mercato.operators.shape import one_row
from mercato.plans.analytics.customer import customer_lookup
from mercato.plans.analytics.executive import customer_count, item_counts
from mercato.plans.analytics.review import numeric_score

# Order-value bands (lower bound inclusive, label) in currency units.
VALUE_BANDS = (
    (0, "<100"),
    (100, "100-1K"),
    (1_000, "1K-10K"),
    (10_000, "10K-100K"),
    (100_000, "100K-1M"),
    (1_000_000, "1M+"),
)


def freight_kpis(fact_orders: DataFrame) -> DataFrame:
    """Total and mean freight; freight as % of revenue (NULL when freight or revenue is 0)."""
    row = fact_orders.agg(
        money_sum_or_zero("total_freight").alias("total_freight"),
        exact_mean("total_freight").alias("avg_freight"),
        F.sum("total_order_value").alias("_revenue"),
    )
    ratio = F.when(
        (F.col("total_freight") != 0) & (F.col("_revenue") != 0),
        F.col("total_freight").cast("double") / F.col("_revenue").cast("double") * F.lit(100.0),
    )
    return row.select("total_freight", "avg_freight", ratio.alias("freight_to_revenue_pct"))


def freight_vs_value(fact_orders: DataFrame, n: int = 5000) -> DataFrame:
    """First ``n`` orders (by id) with both value and freight: the scatter sample."""
    pairs = fact_orders.filter(F.col("total_order_value").isNotNull() & F.col("total_freight").isNotNull())
    return pairs.orderBy("order_id").limit(n).select("total_order_value", "total_freight")


def _delivery_columns(fact_orders: DataFrame) -> DataFrame:
    delivered = F.col("order_delivered_customer_date")
    return fact_orders.select(
        "order_id",
        "customer_id",
        delivered.isNotNull().alias("_delivered"),
        (delivered > F.col("order_estimated_delivery_date")).alias("_late"),
        F.datediff(delivered, F.col("order_purchase_timestamp")).alias("_days"),
        F.datediff(delivered, F.col("order_estimated_delivery_date")).alias("_vs_estimate"),
    )


def delivery_performance(fact_orders: DataFrame) -> DataFrame:
    row = _delivery_columns(fact_orders).agg(
        F.count(F.when(F.col("_delivered"), 1)).alias("delivered_orders"),
        F.count(F.when(F.col("_late"), 1)).alias("late_orders"),
        exact_mean("_days").alias("avg_delivery_days"),
        exact_mean("_vs_estimate").alias("avg_days_vs_estimate"),
    )
    rate = F.when(F.col("delivered_orders") > 0, F.col("late_orders").cast("double") / F.col("delivered_orders"))
    return row.select(
        "delivered_orders", "late_orders", rate.alias("late_rate"), "avg_delivery_days", "avg_days_vs_estimate"
    )


def delivery_by_location(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Delivery counts per customer state, reduced per customer before the join."""
    per_customer = _delivery_columns(fact_orders).groupBy("customer_id").agg(
        F.count(F.when(F.col("_delivered"), 1)).alias("_delivered"),
        F.count(F.when(F.col("_late"), 1)).alias("_late"),
        F.sum("_days").alias("_days_sum"),
        F.count("_days").alias("_days_n"),
    )
    states = customer_lookup(dim_customers, ["customer_state"])
    located = per_customer.join(states, "customer_id", "inner").filter(F.col("customer_state").isNotNull())
    agg = located.groupBy("customer_state").agg(
        F.sum("_delivered").alias("delivered_orders"),
        F.sum("_late").alias("late_orders"),
        F.sum("_days_sum").alias("_days_sum"),
        F.sum("_days_n").alias("_days_n"),
    )
    avg = F.col("_days_sum").cast("double") / F.nullif(F.col("_days_n"), F.lit(0))
    out = agg.select("customer_state", "delivered_orders", "late_orders", avg.alias("avg_delivery_days"))
    return out.orderBy(F.col("late_orders").desc(), F.col("customer_state").asc())


def value_band(c: str = "total_order_value"):
    """(band_order, label) for an order value; values below 0 fall in the first band."""
    order = F.lit(1)
    label = F.lit(VALUE_BANDS[0][1])
    for i, (lower, name) in enumerate(VALUE_BANDS[1:], start=2):
        hit = F.col(c) >= F.lit(lower).cast(MONEY)
        order = F.when(hit, F.lit(i)).otherwise(order)
        label = F.when(hit, F.lit(name)).otherwise(label)
    return order, label


def freight_by_order_value(fact_orders: DataFrame) -> DataFrame:
    order, label = value_band()
    banded = fact_orders.filter(F.col("total_order_value").isNotNull()).select(
        order.alias("band_order"), label.alias("value_band"), "total_order_value", "total_freight"
    )
    agg = banded.groupBy("band_order", "value_band").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_order_value").alias("total_order_value"),
        money_sum_or_zero("total_freight").alias("total_freight"),
    )
    pct = F.when(
        F.col("total_order_value") != 0,
        F.col("total_freight").cast("double") / F.col("total_order_value").cast("double") * F.lit(100.0),
    )
    out = agg.select("value_band", "band_order", "orders", "total_order_value", "total_freight", pct.alias("freight_pct"))
    return out.orderBy("band_order")


def executive_summary(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_customers: DataFrame, fact_reviews: DataFrame
) -> DataFrame:
    """Headline KPIs plus freight, rating and lateness in one row (no joins).

    Everything taken from ``fact_orders`` comes from one aggregation pass.
    """
    order_row = fact_orders.select(
        "order_id", "total_order_value", "total_freight", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ).agg(
        money_sum_or_zero("total_order_value").alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
        money_sum_or_zero("total_freight").alias("total_freight"),
        F.count("order_delivered_customer_date").alias("_delivered"),
        F.count(F.when(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"), 1)).alias("_late"),
    )
    row = one_row(
        order_row,
        customer_count(dim_customers),
        item_counts(fact_order_items),
        numeric_score(fact_reviews).agg(exact_mean("_score").alias("average_rating")),
    )
    aov = F.when(F.col("orders") > 0, F.col("revenue").cast("double") / F.col("orders")).otherwise(F.lit(0.0))
    late_rate = F.when(F.col("_delivered") > 0, F.col("_late").cast("double") / F.col("_delivered"))
    return row.select(
        "revenue", "orders", "customers", "item_records", "distinct_item_seq", aov.alias("average_order_value"),
        "total_freight", "average_rating", late_rate.alias("late_rate"),
    )


def freight_value_correlation(fact_orders: DataFrame) -> DataFrame:
    """Pearson correlation of freight with order value over orders having both.

    All sums are exact (whole cents), so the result does not depend on the order of rows.
    """
    pairs = fact_orders.filter(F.col("total_order_value").isNotNull() & F.col("total_freight").isNotNull())
    x, y = ((F.col(c) * 100).cast("decimal(19,0)") for c in ("total_order_value", "total_freight"))
    whole = "decimal(38,0)"
    sums = pairs.select(x.alias("x"), y.alias("y")).agg(
        F.count(F.lit(1)).alias("orders"),
        *(F.sum(v).cast(whole).alias(n) for n, v in (
            ("sx", F.col("x")), ("sy", F.col("y")), ("sxx", F.col("x") * F.col("x")),
            ("syy", F.col("y") * F.col("y")), ("sxy", F.col("x") * F.col("y")),
        )),
    )
    n = F.col("orders").cast("decimal(19,0)")

    def spread(both: str, a: str, b: str):
        return ((n * F.col(both)).cast(whole) - (F.col(a) * F.col(b)).cast(whole)).cast("double")

    vx, vy = spread("sxx", "sx", "sx"), spread("syy", "sy", "sy")
    r = F.when((vx > 0) & (vy > 0), spread("sxy", "sx", "sy") / (F.sqrt(vx) * F.sqrt(vy)))
    return sums.select("orders", F.round(r, 9).alias("correlation"))
