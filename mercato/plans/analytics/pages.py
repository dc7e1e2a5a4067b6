"""Dashboard pages as named sets of lazy queries over gold tables.

Each function takes the gold tables (``read_gold`` output, or a catalog
listing) and returns ``{query name: DataFrame}`` for one page. Missing tables
behave like the dashboard: a missing mart falls back to the item fact, and a
query whose inputs are absent is left out.

Columns are resolved like the dashboard's too: by the candidates' names in any
case, else by a candidate that is part of a column's name. A query whose columns
do not resolve is left out, and the rest of the page is there. Only a product's
name has to match whole: the length of the name is a column of products too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import conform
from mercato.plans.analytics import customer, delivery, executive, payment, product, review, seller
from mercato.plans.labels import PRODUCT_CATEGORY_CANDIDATES, SELLER_CITY_CANDIDATES, SELLER_NAME_CANDIDATES, SELLER_STATE_CANDIDATES

Gold = Mapping[str, DataFrame]


# The columns that the executive cards read from tables that may be absent.
EMPTY = {
    "fact_orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "total_order_value decimal(18,2), total_freight decimal(18,2), item_count bigint",
    "fact_order_items": "order_id string, order_item_id int, product_id string, price decimal(18,2)",
    "dim_customers": "customer_id string, customer_city string, customer_state string",
}
# The columns that pages read from each table, and the names under which they are looked for.
CANDIDATES: dict[str, dict[str, tuple[str, ...]]] = {
    "fact_orders": {
        "order_id": (), "customer_id": (), "order_status": executive.STATUS_CANDIDATES,
        "total_order_value": executive.REVENUE_CANDIDATES, "total_freight": ("freight_value", "freight"),
        "order_purchase_timestamp": executive.DATE_CANDIDATES, "order_delivered_customer_date": (),
        "order_estimated_delivery_date": (),
    },
    "fact_order_items": {
        "order_id": (), "order_item_id": ("item_id",), "product_id": (), "seller_id": (), "price": executive.PRICE_CANDIDATES,
    },
    "dim_customers": {
        "customer_id": (), "customer_unique_id": (), "customer_city": ("city",), "customer_state": ("state",),
    },
    "dim_products": {"product_id": (), "product_category_name_english": PRODUCT_CATEGORY_CANDIDATES},
    "dim_sellers": {
        "seller_id": (), "seller_name": SELLER_NAME_CANDIDATES[1:], "seller_city": SELLER_CITY_CANDIDATES,
        "seller_state": SELLER_STATE_CANDIDATES,
    },
    "fact_payments": {
        "payment_type": ("method",), "payment_value": ("value", "amount"), "payment_installments": ("installments",),
    },
    "fact_reviews": {
        "review_id": (), "order_id": (), "review_score": review.SCORE_CANDIDATES,
        "review_comment_message": review.COMMENT_CANDIDATES, "review_creation_date": (),
    },
    "sales_by_product": {
        "product_id": (), "units_sold": product.UNITS_CANDIDATES, "product_revenue": product.REVENUE_CANDIDATES,
    },
    "sales_by_seller": {
        "seller_id": (), "seller_revenue": seller.REVENUE_CANDIDATES, "items_sold": seller.UNITS_CANDIDATES,
    },
}
# Columns that are numbers even where they come as text.
NUMBERS = (
    "total_order_value", "total_freight", "price", "payment_value", "product_revenue", "seller_revenue", "units_sold", "items_sold",
)


def conformed(gold: Gold) -> dict[str, DataFrame]:
    """The tables that are there, with the columns that pages read under their usual names."""
    return {
        name: conform(df, CANDIDATES[name], NUMBERS) if name in CANDIDATES else df
        for name, df in gold.items() if df is not None
    }


def _with(df: DataFrame | None, *columns: str) -> bool:
    return df is not None and {c.lower() for c in columns} <= {c.lower() for c in df.columns}


def _filled(gold: Gold, name: str) -> DataFrame | None:
    """The table, or ``None`` if it is absent or has no row (reads one row at most)."""
    df = gold.get(name)
    return None if df is None or df.isEmpty() else df


def _or_empty(gold: Gold, name: str) -> DataFrame:
    df = gold.get(name)
    return df if df is not None else next(iter(gold.values())).sparkSession.createDataFrame([], EMPTY[name])


def _priced(items: DataFrame | None) -> DataFrame | None:
    """Items with a price, NULL where there is none (sums of it are 0)."""
    if items is None or _with(items, "price"):
        return items
    return items.withColumn("price", F.lit(None).cast("decimal(18,2)"))


def executive_page(gold: Gold) -> dict[str, DataFrame]:
    gold = conformed(gold)
    orders, items, customers = (gold.get(n) for n in EMPTY)
    out: dict[str, DataFrame] = {}
    if any(df is not None for df in (orders, items, customers)):
        # a card whose table is missing shows 0
        kpis = executive.executive_kpis(*(_or_empty(gold, name) for name in EMPTY))
        out["kpis"] = kpis
        out["kpi_cards"] = executive.executive_kpi_cards(kpis)
        out["item_order_consistency"] = executive.item_order_consistency(kpis)
    if _with(orders, "order_purchase_timestamp", "total_order_value"):
        out["monthly_revenue"] = executive.monthly_revenue(orders)
    if _with(orders, "order_status"):
        out["order_status"] = executive.order_status_mix(orders)
    label = city = None
    if _with(items, "product_id", "price") and _with(gold.get("dim_products"), "product_id"):
        label = executive.top_revenue_label(items, gold["dim_products"])
    if _with(customers, "customer_id", "customer_city"):
        city = executive.top_customer_city(customers)
    if label is not None or city is not None:
        out["business_insights"] = executive.business_insights(label, city)
    return out


def product_page(gold: Gold) -> dict[str, DataFrame]:
    gold = conformed(gold)
    mart, items, products = _filled(gold, "sales_by_product"), gold.get("fact_order_items"), gold.get("dim_products")
    if mart is None and not _with(items, "product_id"):
        return {}
    sales = product.product_sales(mart, _priced(items))
    out = {}
    if _with(sales, "product_id", "units_sold"):
        out["top_products_by_units"] = product.top_products_by_units(sales, products)
    if _with(sales, "product_id", "product_revenue"):
        out["top_products_by_revenue"] = product.top_products_by_revenue(sales, products)
    measured = _with(sales, "units_sold") or _with(sales, "product_revenue")
    categorised = _with(products, "product_id", "product_category_name_english")
    if categorised and _with(sales, "product_id") and measured:
        out["category_performance"] = product.category_performance(sales, products)
    if _with(products, "product_id") and _with(sales, "product_id", "units_sold"):
        out["low_sales_products"] = product.low_sales_products(products, sales)
    if categorised and _with(items, "order_id", "product_id", "price"):
        out["category_order_volume"] = product.category_order_volume(items, products)
    if _with(items, "price"):
        out["average_product_price"] = product.average_product_price(items)
    return out


def customer_page(gold: Gold) -> dict[str, DataFrame]:
    gold = conformed(gold)
    customers, orders = gold.get("dim_customers"), gold.get("fact_orders")
    out = {}
    if _with(customers, "customer_id", "customer_city"):
        out["customers_by_city"] = customer.customers_by_city(customers)
    if not (_with(customers, "customer_id") and _with(orders, "order_id", "customer_id", "total_order_value")):
        return out
    if _with(customers, "customer_state"):
        out["customer_kpis"] = customer.customer_kpis(orders, customers)
        out["revenue_by_state"] = customer.revenue_by_state(orders, customers)
        out["customer_value_by_location"] = customer.customer_value_by_location(orders, customers)
    if _with(customers, "customer_city"):
        out["revenue_by_city"] = customer.revenue_by_city(orders, customers)
        out["orders_by_city"] = customer.orders_by_city(orders, customers)
    if _with(customers, "customer_unique_id"):
        out["orders_per_customer"] = customer.orders_per_customer(orders, customers)
    return out


def seller_page(gold: Gold) -> dict[str, DataFrame]:
    gold = conformed(gold)
    mart, items, sellers = _filled(gold, "sales_by_seller"), gold.get("fact_order_items"), gold.get("dim_sellers")
    if mart is None and not _with(items, "seller_id"):
        return {}
    sales = seller.seller_sales(mart, items)
    revenue, units = _with(sales, "seller_id", "seller_revenue"), _with(sales, "seller_id", "items_sold")
    out = {}
    if revenue:
        out["top_sellers_by_revenue"] = seller.top_sellers_by_revenue(sales, sellers)
    if units:
        out["top_sellers_by_items"] = seller.top_sellers_by_items(sales, sellers)
    if revenue or units:
        out["seller_performance"] = seller.seller_performance(sales, sellers)
    if _with(items, "seller_id", "order_id"):
        out["seller_order_volume"] = seller.seller_order_volume(items)
    return out


def payment_page(gold: Gold) -> dict[str, DataFrame]:
    p = conformed(gold).get("fact_payments")
    if p is None:
        return {}
    out = {}
    kinds, values, counts = (_with(p, c) for c in ("payment_type", "payment_value", "payment_installments"))
    if values and counts:
        out["payment_kpis"] = payment.payment_kpis(p)
    if kinds and values:
        out["payment_value_by_type"] = payment.payment_value_by_type(p)
    if kinds:
        out["payment_usage_by_type"] = payment.payment_usage_by_type(p)
    if kinds and values and counts:
        out["payment_behaviour"] = payment.payment_behaviour(p)
    return out


def review_page(gold: Gold) -> dict[str, DataFrame]:
    gold = conformed(gold)
    r, items, orders = gold.get("fact_reviews"), gold.get("fact_order_items"), gold.get("fact_orders")
    if not _with(r, "review_score"):
        return {}
    out = {"review_kpis": review.review_kpis(r), "rating_distribution": review.rating_distribution(r)}
    if _with(r, "order_id", "review_id"):
        out["low_rating_reviews"] = review.low_rating_reviews(r)
    if _with(r, "review_creation_date"):
        out["review_trend"] = review.review_trend(r)
    products = gold.get("dim_products")
    if _with(r, "order_id", "review_id") and _with(items, "order_id", "product_id") and _with(
        products, "product_id", "product_category_name_english"
    ):
        out["poor_review_categories"] = review.poor_review_categories(r, items, products)
    customers = gold.get("dim_customers")
    if _with(r, "order_id") and _with(orders, "order_id", "customer_id") and _with(customers, "customer_id", "customer_state"):
        out["review_by_location"] = review.review_by_location(r, orders, customers)
    return out


def delivery_page(gold: Gold) -> dict[str, DataFrame]:
    gold = conformed(gold)
    o, customers = gold.get("fact_orders"), gold.get("dim_customers")
    if o is None:
        return {}
    out = {}
    if _with(o, "order_status"):
        out["order_status"] = executive.order_status_mix(o, ascending=True)
    if _with(o, "total_freight", "total_order_value"):
        out["freight_kpis"] = delivery.freight_kpis(o)
        out["freight_by_order_value"] = delivery.freight_by_order_value(o)
        out["freight_value_correlation"] = delivery.freight_value_correlation(o)
        if _with(o, "order_id"):
            out["freight_vs_value"] = delivery.freight_vs_value(o)
    dates = ("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")
    if _with(o, "order_id", "customer_id", *dates):
        out["delivery_performance"] = delivery.delivery_performance(o)
        if _with(customers, "customer_id", "customer_state"):
            out["delivery_by_location"] = delivery.delivery_by_location(o, customers)
    return out


def explorer_page(spark, gold: Gold, table: str, limit: int | None = None) -> dict[str, DataFrame]:
    """One gold table for inspection: its rows in a fixed order (``limit`` of them if given), its
    row count, and which expected gold tables the catalog holds."""
    from mercato.plans.gold import GOLD_TABLES
    from mercato.plans.quality import table_health
    from mercato.sources.serving import browse, row_count

    if table not in GOLD_TABLES or gold.get(table) is None:
        raise ValueError(f"{table!r} is not an available gold table")
    df = gold[table]
    return {
        "rows": browse(df, limit, df.columns),  # every column: a fixed order even with repeated keys
        "row_count": row_count(df),
        "health": table_health(spark, GOLD_TABLES),
    }


PAGES = {
    "executive": executive_page,
    "product": product_page,
    "customer": customer_page,
    "seller": seller_page,
    "payment": payment_page,
    "review": review_page,
    "delivery": delivery_page,
}
