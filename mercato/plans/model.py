"""Lazy silver + gold frames for one data folder.

``Model(spark, folder)`` exposes silver entities (from the test-table
adapters, or from a silver parquet folder) and the gold tables derived from
them. Nothing runs until an action; a frame built once is reused within a
query so Spark can reuse exchanges of identical sub-plans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import gold
from mercato.sources import testdata


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # silver entities -------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        return testdata.orders(self.spark, self.sf_dir)

    @cached_property
    def order_items(self) -> DataFrame:
        return testdata.order_items(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return testdata.customers(self.spark, self.sf_dir)

    @cached_property
    def sellers(self) -> DataFrame:
        return testdata.sellers(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return testdata.products(self.spark, self.sf_dir)

    @cached_property
    def category_translation(self) -> DataFrame:
        return testdata.category_translation(self.spark, self.sf_dir)

    @cached_property
    def payments(self) -> DataFrame:
        return testdata.payments(self.spark, self.sf_dir)

    @cached_property
    def reviews(self) -> DataFrame:
        return testdata.reviews(self.spark, self.sf_dir)

    @cached_property
    def geolocation(self) -> DataFrame:
        return testdata.geolocation(self.spark, self.sf_dir)

    def silver(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in testdata.ENTITIES}

    # gold ------------------------------------------------------------------
    @cached_property
    def fact_orders(self) -> DataFrame:
        return gold.fact_orders(self.orders, self.order_items, how="left")

    @cached_property
    def fact_orders_inner(self) -> DataFrame:
        return gold.fact_orders(self.orders, self.order_items, how="inner")

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return gold.fact_order_items(self.order_items)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return gold.fact_payments(self.payments)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return gold.fact_reviews(self.reviews)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.customers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.products, self.category_translation)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return gold.dim_sellers(self.sellers)

    @cached_property
    def sales_by_product(self) -> DataFrame:
        return gold.sales_by_product(self.order_items)

    @cached_property
    def sales_by_seller(self) -> DataFrame:
        return gold.sales_by_seller(self.order_items)

    @cached_property
    def sales_by_category(self) -> DataFrame:
        return gold.sales_by_category(self.order_items, self.products, self.category_translation)

    def gold(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in gold.GOLD_TABLES}
