"""Semantic rules on small hand-written frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.functions.columns import ColumnCollisionError, clean_columns, resolve_column, to_datetime, to_number
from mercato.functions.formatting import format_count, format_money
from mercato.functions.money import money_avg
from mercato.functions.text import title_case
from mercato.operators.clean import dedupe_by_key, fill_unknown, parse_timestamps
from mercato.operators.shape import top_n
from mercato.plans import gold
from mercato.plans.analytics import customer, delivery, executive, payment, review
from mercato.plans.labels import add_product_labels, add_seller_labels

D = Decimal


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_title_case_matches_python(spark):
    samples = ["SANTA d'oeste mogi-guaçu são", "rio de janeiro", "3rd street", "NATION_0", "", "são paulo-sp"]
    df = spark.createDataFrame([(s,) for s in samples], "c string")
    got = [r[0] for r in df.select(title_case("c")).collect()]
    assert got == [s.title() for s in samples]


def test_seller_label_null_parts_and_missing_seller(spark):
    sellers = spark.createDataFrame(
        [(1, "mogi-guaçu", "sp"), (2, None, "rj"), (3, "campinas", None)],
        "seller_id bigint, seller_city string, seller_state string",
    )
    sales = spark.createDataFrame([(1, 5), (2, 3), (3, 1), (123456789012345, 9)], "seller_id bigint, items_sold bigint")
    got = dict((r.seller_id, r.seller_label) for r in add_seller_labels(sales, sellers).collect())
    assert got == {1: "Mogi-Guaçu, SP", 2: ", RJ", 3: "Campinas, ", 123456789012345: "123456789012"}


def test_product_label_falls_back_to_id_prefix(spark):
    products = spark.createDataFrame(
        [(1, "beleza", "beauty"), (2, "casa", None)],
        "product_id bigint, product_category_name string, product_category_name_english string",
    )
    items = spark.createDataFrame([(1,), (2,), (98765432109876,)], "product_id bigint")
    got = dict((r.product_id, r.product_label) for r in add_product_labels(items, products).collect())
    assert got == {1: "beauty", 2: "2", 98765432109876: "987654321098"}


def test_resolver_exact_before_substring_and_strict(spark):
    df = spark.createDataFrame([(1, 2, 3)], "product_name_lenght int, Product_ID int, category int")
    assert resolve_column(df, ["product_id"]) == "Product_ID"
    assert resolve_column(df, ["product_name", "category"]) == "category"  # exact beats earlier substring
    assert resolve_column(df, ["product_name"]) == "product_name_lenght"
    assert resolve_column(df, ["product_name"], strict=True) is None


def test_clean_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2.0)], "` Order_ID ` int, PRICE double")
    assert clean_columns(df).columns == ["order_id", "price"]
    with pytest.raises(ColumnCollisionError):
        clean_columns(spark.createDataFrame([(1, 2)], "a int, ` A` int"))


def test_dirty_timestamps_become_null(spark):
    df = spark.createDataFrame(
        [("2018-01-02 10:11:12",), ("junk",), ("",), (None,)], "order_purchase_timestamp string"
    )
    got = [r[0] for r in parse_timestamps(df).collect()]
    assert got[0] == dt.datetime(2018, 1, 2, 10, 11, 12)
    assert got[1:] == [None, None, None]
    assert [r[0] for r in df.select(to_datetime("order_purchase_timestamp")).collect()][1:] == [None] * 3


def test_to_number_coerces_text(spark):
    df = spark.createDataFrame([("5",), ("n/a",), (None,), ("2.5",)], "s string")
    assert [r[0] for r in df.select(to_number("s")).collect()] == [5.0, None, None, 2.5]


def test_half_up_cents_average(spark):
    df = spark.createDataFrame(
        [("a", D("1.00")), ("a", D("1.01")), ("b", D("-1.00")), ("b", D("-1.01")), ("c", None)],
        "k string, p decimal(18,2)",
    )
    got = dict(rows(df.groupBy("k").agg(money_avg("p"))))
    assert got == {"a": 1.01, "b": -1.01, "c": None}


def test_dedupe_by_key_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "z", 3), (1, "a", 9), (2, None, 1), (2, "b", 0)], "product_id int, category string, n int"
    )
    got = sorted(rows(dedupe_by_key(df, ["product_id"])))
    assert got == [(1, "a", 9), (2, None, 1)]
    got_ordered = sorted(rows(dedupe_by_key(df, ["product_id"], order=["n"])))
    assert got_ordered == [(1, "z", 3), (2, "b", 0)]


def test_top_n_ties_break_on_key(spark):
    df = spark.createDataFrame([("c", 10), ("a", 10), ("b", 10), ("d", 5)], "label string, revenue int")
    assert [r.label for r in top_n(df, "revenue", "label", 2).collect()] == ["a", "b"]


def test_monthly_revenue_fills_gap_months_with_zero(spark):
    orders = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 5), D("10.00")), (2, dt.datetime(2020, 3, 9), D("5.50")),
         (3, None, D("99.00")), (4, dt.datetime(2020, 3, 10), None)],
        "order_id int, order_purchase_timestamp timestamp_ntz, total_order_value decimal(18,2)",
    )
    got = rows(executive.monthly_revenue(orders).orderBy("month"))
    assert got == [
        (dt.datetime(2020, 1, 31), D("10.00")),
        (dt.datetime(2020, 2, 29), D("0.00")),
        (dt.datetime(2020, 3, 31), D("5.50")),
    ]


def test_kpis_zero_orders_and_all_null_money(spark):
    orders = spark.createDataFrame(
        [], "order_id int, customer_id int, total_order_value decimal(18,2), total_freight decimal(18,2)"
    )
    items = spark.createDataFrame([], "order_id int, order_item_id int")
    customers = spark.createDataFrame([], "customer_id int")
    k = executive.executive_kpis(orders, items, customers).collect()[0]
    assert (k.revenue, k.orders, k.average_order_value) == (D("0.00"), 0, 0.0)
    f = delivery.freight_kpis(orders).collect()[0]
    assert f.total_freight == D("0.00") and f.avg_freight is None and f.freight_to_revenue_pct is None
    # marts keep NULL when every amount is NULL
    null_items = spark.createDataFrame(
        [(1, 1, 7, None, None)], "order_id int, order_item_id int, product_id int, price decimal(18,2), "
        "freight_value decimal(18,2)",
    )
    sp = gold.sales_by_product(null_items).collect()[0]
    assert sp.product_revenue is None and sp.units_sold == 1


def test_item_sequence_numbers_vs_records(spark):
    orders = spark.createDataFrame([(1, D("1.00")), (2, D("2.00")), (3, D("3.00"))], "order_id int, total_order_value decimal(18,2)")
    items = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "order_id int, order_item_id int")
    customers = spark.createDataFrame([(1,)], "customer_id int")
    k = executive.executive_kpis(orders, items, customers)
    row = k.collect()[0]
    assert (row.item_records, row.distinct_item_seq) == (3, 2)
    c = executive.item_order_consistency(k).collect()[0]
    assert (c.item_count, c.order_count, c.items_below_orders) == (2, 3, True)


def test_status_null_becomes_unknown(spark):
    df = spark.createDataFrame([("delivered",), (None,), ("delivered",)], "order_status string")
    assert rows(executive.order_status_mix(df)) == [("delivered", 2), ("unknown", 1)]
    assert rows(fill_unknown(df, "order_status").filter("order_status = 'unknown'")) == [("unknown",)]


def test_format_money_and_count(spark):
    vals = [D("12.50"), D("1500"), D("2500000"), D("-1500"), None, D("999.99"), D("1250.00")]
    df = spark.createDataFrame([(v,) for v in vals], "v decimal(18,2)")
    got = [r[0] for r in df.select(format_money("v")).collect()]
    assert got == ["$12.50", "$1.5K", "$2.50M", "$-1.5K", "—", "$999.99", "$1.3K"]
    counts = spark.createDataFrame([(1234.9,), (None,), (-5.7,), (1234567.0,)], "v double")
    assert [r[0] for r in counts.select(format_count("v")).collect()] == ["1,234", "—", "-5", "1,234,567"]


def test_null_keys_dropped_in_dashboard_kept_in_marts(spark):
    products = spark.createDataFrame([(1, None), (2, "x")], "product_id int, product_category_name string")
    items = spark.createDataFrame(
        [(1, 1, 1, D("1.00")), (2, 1, 2, D("2.00"))], "order_id int, order_item_id int, product_id int, price decimal(18,2)"
    )
    cat = gold.sales_by_category(items, products, None)
    assert sorted(rows(cat), key=lambda r: str(r[0])) == [(None, 1, D("1.00"), 1.0), ("x", 1, D("2.00"), 2.0)]
    pay = spark.createDataFrame([(None, D("5.00")), ("card", D("2.00"))], "payment_type string, payment_value decimal(18,2)")
    assert rows(payment.payment_value_by_type(pay)) == [("card", D("2.00"))]


def test_low_rating_reviews_order_and_comment(spark):
    reviews = spark.createDataFrame(
        [(3, 30, "1", "t", "bad"), (1, 10, "2", "t", "meh"), (2, 20, "n/a", "t", "x"), (4, 40, "5", "t", "good")],
        "review_id int, order_id int, review_score string, review_comment_title string, review_comment_message string",
    )
    got = rows(review.low_rating_reviews(reviews))
    assert got == [(30, 1.0, "bad"), (10, 2.0, "meh")]
    k = review.review_kpis(reviews).collect()[0]
    assert (k.average_rating, k.review_records, k.valid_ratings) == (8 / 3, 4, 3)


def test_customer_kpis_guarded_divide(spark):
    orders = spark.createDataFrame([], "order_id int, customer_id int, total_order_value decimal(18,2)")
    customers = spark.createDataFrame([], "customer_id int, customer_state string")
    row = customer.customer_kpis(orders, customers).collect()[0]
    assert (row.active_customers, row.customer_revenue, row.avg_customer_value) == (0, D("0.00"), 0.0)


def test_fact_orders_left_vs_inner(spark):
    from mercato.plans.model import Model
    from tests.conftest import SF01

    m = Model(spark, SF01)
    assert m.fact_orders.count() == 15000
    assert m.fact_orders_inner.count() == 14743
    assert m.fact_orders.filter("item_count IS NULL").count() == 257
    assert len(m.fact_orders_inner.columns) == 7


def test_mart_totals_equal_item_totals(spark):
    from mercato.plans.model import Model
    from tests.conftest import SF01

    m = Model(spark, SF01)
    items = m.order_items.agg(F.count("order_item_id").alias("n"), F.sum("price").alias("r")).collect()[0]
    for mart, units, revenue in [
        (m.sales_by_product, "units_sold", "product_revenue"),
        (m.sales_by_seller, "items_sold", "seller_revenue"),
        (m.sales_by_category, "units_sold", "category_revenue"),
    ]:
        t = mart.agg(F.sum(units), F.sum(revenue)).collect()[0]
        assert (t[0], t[1]) == (items.n, items.r)
    assert m.dim_products.count() == m.dim_products.select("product_id").distinct().count()
    assert m.dim_customers.count() == m.dim_customers.select("customer_id").distinct().count()


def test_freight_value_correlation_matches_numpy(spark):
    import numpy as np

    from mercato.plans.model import Model
    from tests.conftest import SF001

    m = Model(spark, SF001)
    pdf = m.fact_orders.select(
        F.col("total_order_value").cast("double").alias("v"), F.col("total_freight").cast("double").alias("f")
    ).dropna().toPandas()
    got = delivery.freight_value_correlation(m.fact_orders).collect()[0]
    assert got.orders == len(pdf)
    assert got.correlation == pytest.approx(np.corrcoef(pdf.v, pdf.f)[0, 1], rel=1e-9)


def test_payment_shares_sum_to_one_and_half_up_average(spark):
    pay = spark.createDataFrame(
        [("card", 1, D("1.00")), ("card", 1, D("1.01")), ("boleto", 2, D("3.00")), (None, 1, D("9.00"))],
        "payment_type string, payment_installments int, payment_value decimal(18,2)",
    )
    got = rows(payment.payment_behaviour(pay))
    assert got == [("boleto", 2, 1, 3.0, 1 / 3), ("card", 1, 2, 1.01, 2 / 3)]


def test_review_trend_keeps_empty_months(spark):
    reviews = spark.createDataFrame(
        [(1, 1, "4", dt.datetime(2021, 1, 3)), (2, 2, "2", dt.datetime(2021, 3, 1)), (3, 3, "x", dt.datetime(2021, 3, 2))],
        "review_id int, order_id int, review_score string, review_creation_date timestamp_ntz",
    )
    got = rows(review.review_trend(reviews))
    assert got == [
        (dt.datetime(2021, 1, 31), 1, 4.0), (dt.datetime(2021, 2, 28), 0, None), (dt.datetime(2021, 3, 31), 2, 2.0)
    ]


def test_review_by_location(spark):
    reviews = spark.createDataFrame(
        [(1, 10, "5"), (2, 11, "1"), (3, 12, "n/a"), (4, 13, "3")], "review_id int, order_id int, review_score string"
    )
    orders = spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, 3)], "order_id int, customer_id int")
    customers = spark.createDataFrame([(1, "SP"), (2, "SP"), (3, None)], "customer_id int, customer_state string")
    assert rows(review.review_by_location(reviews, orders, customers)) == [("SP", 2, 3.0)]


def test_if_columns_applies_only_when_present(spark):
    from mercato.functions.columns import if_columns

    df = spark.createDataFrame([(" A ",)], "product_category_name string")
    f = lambda d: d.withColumn("product_category_name", F.lower(F.trim("product_category_name")))
    assert if_columns(df, ["product_category_name"], f).collect()[0][0] == "a"
    assert if_columns(df, ["missing"], f).collect()[0][0] == " A "


def test_gold_rebuild_is_idempotent(spark, tmp_dir):
    import os

    from mercato.plans.jobs import build_gold
    from mercato.plans.model import Model
    from tests.conftest import SF001

    m = Model(spark, SF001)
    out = os.path.join(tmp_dir, "gold")
    build_gold(spark, "", out, tables=["sales_by_seller", "dim_products"], silver=m.silver())
    first = {t: sorted(map(repr, rows(spark.read.parquet(f"{out}/{t}")))) for t in ["sales_by_seller", "dim_products"]}
    build_gold(spark, "", out, tables=["sales_by_seller", "dim_products"], silver=m.silver())
    second = {t: sorted(map(repr, rows(spark.read.parquet(f"{out}/{t}")))) for t in ["sales_by_seller", "dim_products"]}
    assert first == second


def test_fact_orders_null_order_ids_bypass_the_join(spark):
    orders = spark.createDataFrame(
        [(1, 10, "d", None), (None, 11, "d", None), (None, 12, "x", None), (2, 13, "d", None)],
        "order_id int, customer_id int, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [(1, 1, D("2.00"), D("0.50")), (None, 1, D("9.00"), D("1.00"))],
        "order_id int, order_item_id int, price decimal(18,2), freight_value decimal(18,2)",
    )
    left = sorted(rows(gold.fact_orders(orders, items)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert left == [
        (1, 10, "d", None, D("2.00"), D("0.50"), 1),
        (2, 13, "d", None, None, None, None),
        (None, 11, "d", None, None, None, None),
        (None, 12, "x", None, None, None, None),
    ]
    assert rows(gold.fact_orders(orders, items, how="inner")) == [(1, 10, "d", None, D("2.00"), D("0.50"), 1)]


def test_display_formatters(spark):
    from mercato.functions.formatting import format_one_decimal, format_percent, format_rating

    df = spark.createDataFrame([(4.0 / 3, 12.345, 2.25), (None, None, None)], "r double, p double, i double")
    got = [tuple(r) for r in df.select(format_rating("r"), format_percent("p"), format_one_decimal("i")).collect()]
    assert got == [("1.33 / 5", "12.3%", "2.3"), ("—", "—", "—")]


def test_monthly_revenue_parses_text_dates(spark):
    orders = spark.createDataFrame(
        [(1, "2021-01-31 23:30:00", D("1.00")), (2, "junk", D("5.00")), (3, "2021-02-01 00:10:00", D("2.00"))],
        "order_id int, order_purchase_timestamp string, total_order_value decimal(18,2)",
    )
    got = rows(executive.monthly_revenue(orders).orderBy("month"))
    assert got == [(dt.datetime(2021, 1, 31), D("1.00")), (dt.datetime(2021, 2, 28), D("2.00"))]
