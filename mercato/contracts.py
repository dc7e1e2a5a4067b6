"""Entity contracts: raw CSV schemas, keys and file names (FIXTURES.md section B).

Explicit schemas replace schema inference (an extra pass over every file, and
the cause of scores drifting to text). Timestamps and money are read as text
and parsed with ``try_*`` functions so malformed values become NULL instead of
failing the job under ANSI mode.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()


@dataclass(frozen=True)
class Entity:
    name: str
    file: str
    schema: T.StructType | None
    keys: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    money: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    normalise: tuple[str, ...] = ()
    multiline: bool = False
    extra: dict = field(default_factory=dict)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


# Raw file names and column names of the source dataset.
ENTITIES: dict[str, Entity] = {
    "orders": Entity(
        "orders", "olist_orders_dataset.csv",
        _strings("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                 "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"),
        keys=("order_id",),
        timestamps=("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date"),
    ),
    "order_items": Entity(
        "order_items", "olist_order_items_dataset.csv",
        _strings("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                 "freight_value"),
        keys=("order_id", "order_item_id"),
        timestamps=("shipping_limit_date",), money=("price", "freight_value"), integers=("order_item_id",),
    ),
    "customers": Entity(
        "customers", "olist_customers_dataset.csv",
        _strings("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        keys=("customer_id",), integers=("customer_zip_code_prefix",),
    ),
    "products": Entity(
        "products", "olist_products_dataset.csv", None, keys=("product_id",), normalise=("product_category_name",),
        integers=("product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
                  "product_length_cm", "product_height_cm", "product_width_cm"),
    ),
    "sellers": Entity(
        "sellers", "olist_sellers_dataset.csv",
        _strings("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        keys=("seller_id",), integers=("seller_zip_code_prefix",),
    ),
    "payments": Entity(
        "payments", "olist_order_payments_dataset.csv",
        _strings("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        keys=("order_id", "payment_sequential"), money=("payment_value",),
        integers=("payment_sequential", "payment_installments"),
    ),
    "reviews": Entity(
        "reviews", "olist_order_reviews_dataset.csv",
        _strings("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                 "review_creation_date", "review_answer_timestamp"),
        keys=("review_id",), timestamps=("review_creation_date", "review_answer_timestamp"),
        integers=("review_score",), multiline=True,
    ),
    "geolocation": Entity(
        "geolocation", "olist_geolocation_dataset.csv", None, integers=("geolocation_zip_code_prefix",),
        doubles=("geolocation_lat", "geolocation_lng"),
    ),
    "category_translation": Entity(
        "category_translation", "product_category_name_translation.csv",
        _strings("product_category_name", "product_category_name_english"),
        keys=("product_category_name",), normalise=("product_category_name",),
    ),
}

# The serving DDL for the two typed tables (types, lengths, key).
SERVING_DDL = {
    "fact_orders": T.StructType([
        T.StructField("order_id", T.VarcharType(50), False),
        T.StructField("customer_id", T.VarcharType(50), True),
        T.StructField("order_status", T.VarcharType(20), True),
        T.StructField("order_purchase_timestamp", T.TimestampType(), True),
        T.StructField("total_order_value", T.DecimalType(10, 2), True),
        T.StructField("total_freight", T.DecimalType(10, 2), True),
        T.StructField("item_count", I, True),
    ]),
    "dim_customers": T.StructType([
        T.StructField("customer_id", T.VarcharType(50), False),
        T.StructField("customer_unique_id", T.VarcharType(50), True),
        T.StructField("customer_zip_code_prefix", I, True),
        T.StructField("customer_city", T.VarcharType(100), True),
        T.StructField("customer_state", T.VarcharType(10), True),
    ]),
}
SERVING_KEYS = {"fact_orders": ("order_id",), "dim_customers": ("customer_id",)}
