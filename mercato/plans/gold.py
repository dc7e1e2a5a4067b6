"""Gold star schema: facts, dimensions and sales marts (silver -> gold).

Money stays DECIMAL here; outputs are cast to double at the edge. Marts are
written unsorted: order is applied at query time (sorting before a parquet
write is lost on a multi-file read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.money import avg_cents_half_up, money_sum
from mercato.operators.clean import dedupe_by_key, project

# Gold column lists.
DIM_CUSTOMERS_COLUMNS = (
    "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
)
DIM_SELLERS_COLUMNS = ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
FACT_ORDER_ITEMS_COLUMNS = (
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
)
FACT_PAYMENTS_COLUMNS = ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")
FACT_REVIEWS_COLUMNS = (
    "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
    "review_creation_date", "review_answer_timestamp",
)
FACT_ORDERS_BASE = ("order_id", "customer_id", "order_status", "order_purchase_timestamp")
FACT_ORDERS_DELIVERY = (
    "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
ORDER_METRICS = ("total_order_value", "total_freight", "item_count")
GOLD_TABLES = (
    "fact_orders", "fact_order_items", "dim_customers", "dim_products", "dim_sellers",
    "fact_payments", "fact_reviews", "sales_by_product", "sales_by_seller", "sales_by_category",
)


def order_metrics(order_items: DataFrame) -> DataFrame:
    """Per order: value and freight sums and the item count (partial+final aggregate)."""
    return order_items.groupBy("order_id").agg(
        money_sum("price").alias("total_order_value"),
        money_sum("freight_value").alias("total_freight"),
        F.count("order_item_id").alias("item_count"),
    )


def fact_orders(orders: DataFrame, order_items: DataFrame, how: str = "left") -> DataFrame:
    """Orders with their metrics. ``left`` keeps orders without items (metrics NULL);
    ``inner`` is the 7-column local form."""
    return orders_with_metrics(orders, order_metrics(order_items), how)


def orders_with_metrics(orders: DataFrame, metrics: DataFrame, how: str = "left") -> DataFrame:
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', got {how!r}")
    # one scan of orders; orders without an id keep NULL metrics, and AQE splits their
    # partition if it is large (the left side of a left join may be split)
    joined = orders.join(metrics, on="order_id", how=how)
    delivery = tuple(c for c in FACT_ORDERS_DELIVERY if c in joined.columns) if how == "left" else ()
    return project(joined, FACT_ORDERS_BASE + delivery + ORDER_METRICS)


def fact_order_items(order_items: DataFrame) -> DataFrame:
    items = project(order_items, FACT_ORDER_ITEMS_COLUMNS)
    return items.withColumn("item_revenue", F.round(F.col("price") + F.col("freight_value"), 2))


def fact_payments(payments: DataFrame) -> DataFrame:
    return project(payments, FACT_PAYMENTS_COLUMNS)


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return project(reviews, FACT_REVIEWS_COLUMNS)


def dim_customers(customers: DataFrame) -> DataFrame:
    return project(customers, DIM_CUSTOMERS_COLUMNS).distinct()


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return project(sellers, DIM_SELLERS_COLUMNS).distinct()


def dim_products(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """Products with the English category; one row per product (smallest row wins)."""
    dim = products
    if translation is not None and "product_category_name" in dim.columns:
        dim = dim.join(translation, on="product_category_name", how="left")
    return dedupe_by_key(dim, ["product_id"])


def sales_by_product(order_items: DataFrame) -> DataFrame:
    return _product_of(product_totals(order_items))


def _product_of(totals: DataFrame) -> DataFrame:
    return totals.select(
        "product_id",
        F.col("_units").alias("units_sold"),
        F.round("_revenue", 2).alias("product_revenue"),
        avg_cents_half_up(F.col("_revenue") * 100, F.col("_priced")).alias("average_price"),
        F.round("_freight", 2).alias("total_freight"),
    )


def sales_by_seller(order_items: DataFrame) -> DataFrame:
    """Per seller. ``orders_handled`` counts item rows (as the source did);
    ``distinct_orders`` is the number of different orders."""
    return order_items.groupBy("seller_id").agg(
        F.count("order_item_id").alias("items_sold"),
        F.count("order_id").alias("orders_handled"),
        money_sum("price").alias("seller_revenue"),
        money_sum("freight_value").alias("seller_freight"),
        F.countDistinct("order_id").alias("distinct_orders"),
    )


def seller_orders(order_items: DataFrame) -> DataFrame:
    """Per (order, seller): sums and counts that merge into ``order_metrics`` and ``sales_by_seller``."""
    return order_items.groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("_value"),
        F.sum("freight_value").alias("_freight"),
        F.count("order_item_id").alias("_items"),
        F.count("order_id").alias("_handled"),
    )


def order_metrics_of(pairs: DataFrame) -> DataFrame:
    """``order_metrics`` from :func:`seller_orders`."""
    return pairs.groupBy("order_id").agg(
        money_sum("_value").alias("total_order_value"),
        money_sum("_freight").alias("total_freight"),
        F.sum("_items").alias("item_count"),
    )


def sales_by_seller_of(pairs: DataFrame) -> DataFrame:
    """``sales_by_seller`` from :func:`seller_orders`; each pair is one order of the seller."""
    return pairs.groupBy("seller_id").agg(
        F.sum("_items").alias("items_sold"),
        F.sum("_handled").alias("orders_handled"),
        money_sum("_value").alias("seller_revenue"),
        money_sum("_freight").alias("seller_freight"),
        F.count("order_id").alias("distinct_orders"),
    )


def category_products(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    cp = products.select("product_id", "product_category_name")
    if translation is not None and "product_category_name_english" in translation.columns:
        t = translation.select("product_category_name", "product_category_name_english")
        cp = cp.join(t, on="product_category_name", how="left")
    return cp


def sales_by_category(order_items: DataFrame, products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """Per (category, English name); the NULL category group is kept.

    Items are pre-aggregated per product before the join, so the join and the
    final shuffle run at product grain instead of item grain; the result equals
    joining every item (counts and cent sums add up exactly).
    """
    return _category_of(product_totals(order_items), products, translation)


def product_totals(order_items: DataFrame) -> DataFrame:
    """Per product: what both the product and the category mart need from the items."""
    freight = [F.sum("freight_value").alias("_freight")] if "freight_value" in order_items.columns else []
    return order_items.groupBy("product_id").agg(
        F.count("order_item_id").alias("_units"),
        F.sum("price").alias("_revenue"),
        F.count("price").alias("_priced"),
        *freight,
    )


def _category_of(per_product: DataFrame, products: DataFrame, translation: DataFrame | None) -> DataFrame:
    cp = category_products(products, translation)
    keys = ["product_category_name"] + (
        ["product_category_name_english"] if "product_category_name_english" in cp.columns else []
    )
    joined = per_product.join(cp, on="product_id", how="left")
    agg = joined.groupBy(*keys).agg(
        F.coalesce(F.sum("_units"), F.lit(0)).cast("bigint").alias("units_sold"),
        F.round(F.sum("_revenue"), 2).alias("category_revenue"),
        F.sum("_priced").alias("_priced"),
    )
    return agg.select(
        *keys, "units_sold", "category_revenue",
        avg_cents_half_up(F.col("category_revenue") * 100, F.col("_priced")).alias("average_price"),
    )


def tables_of_states(silver: dict[str, DataFrame], pairs: DataFrame, totals: DataFrame, how: str = "left") -> dict[str, DataFrame]:
    """The tables that are rolled up from stored partial states (:func:`seller_orders`, :func:`product_totals`)."""
    return {
        "fact_orders": orders_with_metrics(silver["orders"], order_metrics_of(pairs), how),
        "sales_by_product": _product_of(totals),
        "sales_by_seller": sales_by_seller_of(pairs),
        "sales_by_category": _category_of(totals, silver["products"], silver.get("category_translation")),
    }


def build_gold_tables(silver: dict[str, DataFrame], how: str = "left") -> dict[str, DataFrame]:
    """All ten gold tables from silver entity frames (lazy)."""
    items = silver["order_items"]
    translation = silver.get("category_translation")
    return {
        "dim_customers": dim_customers(silver["customers"]),
        "dim_products": dim_products(silver["products"], translation),
        "dim_sellers": dim_sellers(silver["sellers"]),
        "fact_order_items": fact_order_items(items),
        "fact_orders": fact_orders(silver["orders"], items, how=how),
        "fact_payments": fact_payments(silver["payments"]),
        "fact_reviews": fact_reviews(silver["reviews"]),
        "sales_by_product": sales_by_product(items),
        "sales_by_seller": sales_by_seller(items),
        "sales_by_category": sales_by_category(items, silver["products"], translation),
    }
