"""Dirt laid over the entity views: NULL and orphan ids, repeated dimension rows, missing values, gap months.

Every rule depends on the rows' own ids, so the dirt grows with the tables and
the DuckDB twin (``mercato.oracle.DIRT``) can repeat it. Orphan ids are the
negated ones, which no parent has.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.plans.model import Model

#: Purchases of these months have no timestamp, so the month series has gaps.
GAP_MONTHS = (3, 4, 9)


def _every(key: Column, n: int, rest: int) -> Column:
    return key % n == rest


def _spoil(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Replace columns in place, all from the clean values."""
    return df.select(*(rules[c].cast(df.schema[c].dataType).alias(c) if c in rules else F.col(c) for c in df.columns))


def _null(column: str, when: Column) -> Column:
    return F.when(~when, F.col(column))


def _orphan(column: str, null: Column, orphan: Column) -> Column:
    return F.when(null, F.lit(None)).when(orphan, -F.col(column)).otherwise(F.col(column))


class DirtyModel(Model):
    """The model over dirty entities; the gold tables and queries are those of :class:`Model`."""

    @cached_property
    def orders(self) -> DataFrame:
        k = F.col("order_id")
        bought = F.col("order_purchase_timestamp")
        return _spoil(super().orders, {
            "order_id": _null("order_id", _every(k, 31, 11)),
            "customer_id": _orphan("customer_id", _every(k, 13, 1), _every(k, 17, 2)),
            "order_status": _null("order_status", _every(k, 19, 3)),
            "order_purchase_timestamp": _null(
                "order_purchase_timestamp", F.month(bought).isin(*GAP_MONTHS) | _every(k, 23, 5)),
            "order_delivered_customer_date": _null("order_delivered_customer_date", _every(k, 29, 7)),
        })

    @cached_property
    def order_items(self) -> DataFrame:
        j = F.col("order_id") * 7 + F.col("order_item_id")
        unpriced = _every(F.col("product_id"), 50, 0)  # products whose prices are all NULL
        return _spoil(super().order_items, {
            "order_id": _orphan("order_id", _every(j, 37, 1), _every(j, 41, 2)),
            "product_id": _orphan("product_id", _every(j, 43, 3), _every(j, 47, 4)),
            "seller_id": _null("seller_id", _every(j, 53, 5)),
            "price": _null("price", _every(j, 11, 6) | unpriced),
            "freight_value": _null("freight_value", _every(j, 13, 7)),
        })

    @cached_property
    def customers(self) -> DataFrame:
        clean, k = super().customers, F.col("customer_id")
        again = clean.where(_every(k, 10, 3))  # customers listed twice, in two places
        return _spoil(clean, {"customer_id": _null("customer_id", _every(k, 21, 4))}).unionByName(
            _spoil(again, {"customer_city": F.lit("Second City"), "customer_state": _null("customer_state", _every(k, 20, 3))}))

    @cached_property
    def sellers(self) -> DataFrame:
        clean, k = super().sellers, F.col("seller_id")
        return _spoil(clean, {
            "seller_city": _null("seller_city", _every(k, 7, 2)),
            "seller_state": _null("seller_state", _every(k, 11, 3)),
        }).unionByName(_spoil(clean.where(_every(k, 9, 4)), {"seller_city": F.lit("second town")}))

    @cached_property
    def products(self) -> DataFrame:
        k = F.col("product_id")
        return _spoil(super().products, {
            "product_id": _null("product_id", _every(k, 71, 2)),
            "product_category_name": _null("product_category_name", _every(k, 15, 1)),
        })

    @cached_property
    def payments(self) -> DataFrame:
        clean, k = super().payments, F.col("order_id")
        return _spoil(clean, {
            "order_id": _null("order_id", _every(k, 29, 3)),
            "payment_type": _null("payment_type", _every(k, 17, 4)),
            "payment_installments": _null("payment_installments", _every(k, 19, 6)),
            "payment_value": _null("payment_value", _every(k, 13, 5)),
        }).unionByName(_spoil(clean.where(_every(k, 5, 0)), {"payment_sequential": F.lit(2)}))

    @cached_property
    def reviews(self) -> DataFrame:
        k = F.col("review_id")
        months = F.when(_every(k, 3, 0), 0).when(_every(k, 3, 1), 2).otherwise(7)
        return _spoil(super().reviews, {
            "order_id": _orphan("order_id", _every(k, 31, 3), _every(k, 37, 4)),
            "review_score": F.when(_every(k, 41, 5), F.lit(None)).when(_every(k, 43, 6), "").otherwise(F.col("review_score")),
            "review_creation_date": F.when(
                ~_every(k, 47, 8), F.col("review_creation_date") + F.make_ym_interval(F.lit(0), months)),
        })
