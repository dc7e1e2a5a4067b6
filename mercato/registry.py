"""Named queries: ``name -> (spark, sf_dir) -> DataFrame`` over the test tables.

Every query reads the given parquet tables through the entity adapters and
returns a lazy DataFrame whose decimal columns are cast to double at the edge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.columns import clean_columns, to_datetime, to_number
from mercato.functions.formatting import format_count, format_money
from mercato.functions.money import to_output
from mercato.operators.clean import (
    dedupe_by_key,
    dedupe_rows,
    drop_null,
    fill_unknown,
    low_rating,
    normalise_columns,
    parse_timestamps,
    ORDER_TIMESTAMP_COLUMNS,
)
from mercato.operators.shape import ranked
from mercato.plans import gold, quality
from mercato.plans.analytics import customer, delivery, executive, payment, product, review, seller
from mercato.plans.labels import add_product_labels, add_seller_labels
from mercato.plans.model import Model
from mercato.sources import testdata
from mercato.sources.dirty import DirtyModel

Query = Callable[[SparkSession, str], DataFrame]

# The serving contract for fact_orders (types, lengths, key).
FACT_ORDERS_CONTRACT = (
    quality.Rule("order_id", "varchar", length=50),
    quality.Rule("order_id", "not_null"),
    quality.Rule("order_id", "unique"),
    quality.Rule("customer_id", "varchar", length=50),
    quality.Rule("order_status", "varchar", length=20),
    quality.Rule("order_purchase_timestamp", "timestamp"),
    quality.Rule("total_order_value", "numeric", precision=10, scale=2),
    quality.Rule("total_freight", "numeric", precision=10, scale=2),
    quality.Rule("item_count", "int"),
)
# Allowed review scores.
REVIEW_SCORES = ("1", "2", "3", "4", "5")
#: Statuses of settled orders, and payment types that name a method.
SETTLED_STATUSES = ("F", "O")
NAMED_PAYMENT_TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")


def _q(fn: Callable[[Model], DataFrame], model: type[Model] = Model) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_output(fn(model(spark, sf_dir)))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _kpis(m: Model) -> DataFrame:
    return executive.executive_kpis(m.fact_orders, m.fact_order_items, m.dim_customers)


def _dirty_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"  {c.upper()} " for c in df.columns])


def _silver_orders(m: Model) -> DataFrame:
    as_text = m.orders.withColumns({c: F.col(c).cast("string") for c in ORDER_TIMESTAMP_COLUMNS})
    return dedupe_rows(parse_timestamps(as_text))


def _silver_products(m: Model) -> DataFrame:
    raw = testdata.products_raw(m.spark, m.sf_dir)
    return dedupe_rows(normalise_columns(raw, ["product_category_name"]))


def _silver_translation(m: Model) -> DataFrame:
    """Translation rows derived from the raw part types (upper case, as landed),
    normalised on the join key and de-duplicated like the silver job does."""
    part = testdata.table(m.spark, m.sf_dir, "part")
    raw = part.select(
        F.col("p_type").alias("product_category_name"),
        F.concat(F.lower(F.col("p_type")), F.lit("_en")).alias("product_category_name_english"),
    )
    return dedupe_rows(normalise_columns(raw, ["product_category_name"]))


def _dedupe_lineitem(m: Model) -> DataFrame:
    li = testdata.table(m.spark, m.sf_dir, "lineitem")
    return dedupe_by_key(li, ["l_orderkey", "l_linenumber"])


def _to_datetime(m: Model) -> DataFrame:
    ev = testdata.table(m.spark, m.sf_dir, "events")
    text = F.when(F.col("event_id") % 13 == 0, F.lit("junk")).otherwise(F.col("ts").cast("string"))
    return ev.select("event_id", to_datetime(text).alias("parsed_ts"))


def _orphans(m: Model) -> DataFrame:
    # fact_orders has the orders' ids, and an order has items if the items have its id
    items, orders = m.fact_order_items, m.orders
    R = quality.Reference
    return quality.orphan_summary({
        "order_items.order_id -> orders": R("order", (items, "order_id"), ((orders, "order_id"),)),
        "order_items.product_id -> products": R("product", (items, "product_id"), ((m.dim_products, "product_id"),)),
        "order_items.seller_id -> sellers": R("seller", (items, "seller_id"), ((m.dim_sellers, "seller_id"),)),
        "orders.customer_id -> customers": R("customer", (orders, "customer_id"), ((m.dim_customers, "customer_id"),)),
        "payments.order_id -> orders": R("order", (m.fact_payments, "order_id"), ((orders, "order_id"),)),
        "reviews.order_id -> orders with items": R(
            "order", (m.fact_reviews, "order_id"), ((orders, "order_id"), (items, "order_id"))),
    })


def _business_insights(m: Model) -> DataFrame:
    return executive.business_insights(
        executive.top_revenue_label(m.fact_order_items, m.dim_products),
        executive.top_customer_city(m.dim_customers),
    )


_QUERIES: dict[str, Callable[[Model], DataFrame]] = {
    # gold: facts, dimensions, marts
    "order_metrics": lambda m: gold.order_metrics(m.order_items),
    # item_count is NULL for orders without items; the registry returns it as double so a NULL-able count
    # has one representation in every client (pandas turns a NULL-able bigint into float64).
    "fact_orders": lambda m: m.fact_orders.withColumn("item_count", F.col("item_count").cast("double")),
    "fact_orders_inner": lambda m: m.fact_orders_inner,
    "fact_order_items": lambda m: m.fact_order_items,
    "fact_payments": lambda m: m.fact_payments,
    "fact_reviews": lambda m: m.fact_reviews,
    "dim_customers": lambda m: m.dim_customers,
    "dim_products": lambda m: m.dim_products,
    "dim_sellers": lambda m: m.dim_sellers,
    "sales_by_product": lambda m: m.sales_by_product.orderBy(*ranked(m.sales_by_product, "units_sold", "product_id")),
    "sales_by_seller": lambda m: m.sales_by_seller.orderBy(*ranked(m.sales_by_seller, "seller_revenue", "seller_id")),
    "sales_by_category": lambda m: m.sales_by_category.orderBy(
        *ranked(m.sales_by_category, "category_revenue", "product_category_name")),
    # labels
    "product_labels": lambda m: add_product_labels(m.sales_by_product, m.dim_products),
    "seller_labels": lambda m: add_seller_labels(m.sales_by_seller, m.dim_sellers),
    # executive overview
    "executive_kpis": _kpis,
    "executive_kpi_cards": lambda m: executive.executive_kpi_cards(_kpis(m)),
    "item_order_consistency": lambda m: executive.item_order_consistency(_kpis(m)),
    "monthly_revenue": lambda m: executive.monthly_revenue(m.fact_orders),
    "order_status_mix": lambda m: executive.order_status_mix(m.fact_orders),
    "order_status_asc": lambda m: executive.order_status_mix(m.fact_orders, ascending=True),
    "top_revenue_label": lambda m: executive.top_revenue_label(m.fact_order_items, m.dim_products),
    "top_customer_city": lambda m: executive.top_customer_city(m.dim_customers),
    "business_insights": _business_insights,
    # products
    "product_sales_fallback": lambda m: product.product_sales_fallback(m.fact_order_items),
    "top_products_by_units": lambda m: product.top_products_by_units(m.sales_by_product, m.dim_products),
    "top_products_by_revenue": lambda m: product.top_products_by_revenue(m.sales_by_product, m.dim_products),
    "category_performance": lambda m: product.category_performance(m.sales_by_product, m.dim_products),
    "low_sales_products": lambda m: product.low_sales_products(m.dim_products, m.sales_by_product),
    "category_order_volume": lambda m: product.category_order_volume(m.fact_order_items, m.dim_products),
    "average_product_price": lambda m: product.average_product_price(m.fact_order_items),
    # customers
    "customer_kpis": lambda m: customer.customer_kpis(m.fact_orders, m.dim_customers),
    "revenue_by_state": lambda m: customer.revenue_by_state(m.fact_orders, m.dim_customers),
    "customers_by_city": lambda m: customer.customers_by_city(m.dim_customers),
    "revenue_by_city": lambda m: customer.revenue_by_city(m.fact_orders, m.dim_customers),
    "orders_by_city": lambda m: customer.orders_by_city(m.fact_orders, m.dim_customers),
    "orders_per_customer": lambda m: customer.orders_per_customer(m.fact_orders, m.dim_customers),
    "customer_value_by_location": lambda m: customer.customer_value_by_location(m.fact_orders, m.dim_customers),
    # sellers
    "seller_sales_fallback": lambda m: seller.seller_sales_fallback(m.fact_order_items),
    "top_sellers_by_revenue": lambda m: seller.top_sellers_by_revenue(m.sales_by_seller, m.dim_sellers),
    "top_sellers_by_items": lambda m: seller.top_sellers_by_items(m.sales_by_seller, m.dim_sellers),
    "seller_performance": lambda m: seller.seller_performance(m.sales_by_seller, m.dim_sellers),
    "seller_order_volume": lambda m: seller.seller_order_volume(m.fact_order_items),
    # payments
    "payment_kpis": lambda m: payment.payment_kpis(m.fact_payments),
    "payment_value_by_type": lambda m: payment.payment_value_by_type(m.fact_payments),
    "payment_usage_by_type": lambda m: payment.payment_usage_by_type(m.fact_payments),
    "payment_behaviour": lambda m: payment.payment_behaviour(m.fact_payments),
    # reviews
    "review_kpis": lambda m: review.review_kpis(m.fact_reviews),
    "rating_distribution": lambda m: review.rating_distribution(m.fact_reviews),
    "low_rating_reviews": lambda m: review.low_rating_reviews(m.fact_reviews),
    "review_trend": lambda m: review.review_trend(m.fact_reviews),
    "review_by_location": lambda m: review.review_by_location(m.fact_reviews, m.fact_orders, m.dim_customers),
    "poor_review_categories": lambda m: review.poor_review_categories(
        m.fact_reviews, m.fact_order_items, m.dim_products),
    # delivery and logistics
    "freight_kpis": lambda m: delivery.freight_kpis(m.fact_orders),
    "freight_vs_value": lambda m: delivery.freight_vs_value(m.fact_orders),
    "delivery_performance": lambda m: delivery.delivery_performance(m.fact_orders),
    "delivery_by_location": lambda m: delivery.delivery_by_location(m.fact_orders, m.dim_customers),
    "freight_by_order_value": lambda m: delivery.freight_by_order_value(m.fact_orders),
    "freight_value_correlation": lambda m: delivery.freight_value_correlation(m.fact_orders),
    "executive_summary": lambda m: delivery.executive_summary(
        m.fact_orders, m.fact_order_items, m.dim_customers, m.fact_reviews),
    # data quality
    "table_counts": lambda m: quality.table_counts(m.gold()),
    "null_profile": lambda m: quality.null_profile(m.fact_orders),
    "key_uniqueness": lambda m: quality.key_uniqueness(m.fact_order_items, ["order_id", "order_item_id"]),
    "orphan_keys": _orphans,
    "schema_enforcement": lambda m: quality.schema_enforcement(m.fact_orders, FACT_ORDERS_CONTRACT),
    "domain_check": lambda m: quality.domain_check(m.fact_reviews, "review_score", REVIEW_SCORES),
    "domain_check_status": lambda m: quality.domain_check(m.orders, "order_status", SETTLED_STATUSES),
    "domain_check_payment_type": lambda m: quality.domain_check(m.fact_payments, "payment_type", NAMED_PAYMENT_TYPES),
    # stage operators (silver cleaning and column functions)
    "silver_geolocation": lambda m: dedupe_rows(m.geolocation),
    "silver_customers": lambda m: dedupe_rows(clean_columns(_dirty_names(m.customers))),
    "silver_orders": _silver_orders,
    "silver_products": _silver_products,
    "silver_translation": _silver_translation,
    "dedupe_by_key": _dedupe_lineitem,
    "clean_columns": lambda m: clean_columns(_dirty_names(m.order_items)),
    "to_number": lambda m: m.fact_reviews.select(
        "review_id", to_number("review_score").alias("review_score_number")),
    "to_datetime": _to_datetime,
    "drop_null": lambda m: drop_null(m.fact_orders.select("order_id", "total_order_value"), ["total_order_value"]),
    "fill_unknown": lambda m: fill_unknown(m.dim_customers.select("customer_id", "customer_state"), "customer_state"),
    "low_rating": lambda m: low_rating(
        m.fact_reviews.select("review_id", "order_id", to_number("review_score").alias("review_score"))),
    "format_money": lambda m: m.fact_orders.select(
        "order_id", "total_order_value", format_money("total_order_value").alias("value_text")),
    "format_count": lambda m: m.fact_orders.select(
        "order_id", "total_order_value", format_count("total_order_value").alias("value_count_text")),
}

#: Queries that are also registered over the dirty entities, as ``dirty_<name>``.
OVER_DIRT = (
    "fact_orders", "dim_products", "sales_by_product", "sales_by_seller", "sales_by_category", "executive_kpis",
    "executive_summary", "monthly_revenue", "order_status_mix", "product_sales_fallback", "low_sales_products",
    "customer_kpis", "revenue_by_state", "orders_by_city", "customer_value_by_location", "seller_performance",
    "payment_behaviour", "review_trend", "review_by_location", "poor_review_categories", "delivery_by_location",
    "null_profile", "key_uniqueness", "orphan_keys",
)

QUERIES: dict[str, Query] = {name: _q(fn) for name, fn in _QUERIES.items()}
QUERIES.update({f"dirty_{name}": _q(_QUERIES[name], DirtyModel) for name in OVER_DIRT})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_orders: orders left-joined to per-order item metrics."""
    return QUERIES["fact_orders"](spark, sf_dir)
