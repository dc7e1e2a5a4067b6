"""Hot keys: one product, seller, order and customer each hold a third of the rows.

Results must equal a pandas brute force whatever plan Spark picks: with
broadcasts disabled and aggressive AQE skew-join splitting, and with AQE off.
"""


import pytest
from pyspark.sql import functions as F

from mercato.plans import gold
from mercato.plans.analytics import customer, product, review

N = 30_000
HOT = 7


@pytest.fixture(scope="module")
def frames(spark):
    ids = spark.range(N)
    hot = (F.col("id") % 3 == 0)
    items = ids.select(
        F.when(hot, F.lit(HOT)).otherwise(F.floor(F.col("id") / 3) + 100).alias("order_id"),
        (F.col("id") % 5 + 1).cast("int").alias("order_item_id"),
        F.when(hot, F.lit(HOT)).otherwise(F.col("id") % 990 + 8).alias("product_id"),
        F.when(hot, F.lit(HOT)).otherwise(F.col("id") % 89 + 8).alias("seller_id"),
        ((F.col("id") * 37 % 100000) / 100).cast("decimal(18,2)").alias("price"),
        ((F.col("id") * 11 % 2000) / 100).cast("decimal(18,2)").alias("freight_value"),
    )
    order_ids = items.select("order_id").distinct()
    orders = order_ids.select(
        "order_id",
        F.when(F.col("order_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("order_id") % 500).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit(None).cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )
    products = spark.range(1000).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") == HOT, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 9).cast("string")))
        .alias("product_category_name"),
    )
    translation = spark.createDataFrame([("hot", "hot_en"), ("c1", "c1_en")],
                                        "product_category_name string, product_category_name_english string")
    customers = spark.range(500).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("u"), (F.col("id") % 50).cast("string")).alias("customer_unique_id"),
        F.lit(1).alias("customer_zip_code_prefix"), F.lit("city").alias("customer_city"),
        F.when(F.col("id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("customer_state"),
    )
    reviews = order_ids.select(
        F.col("order_id").alias("review_id"), "order_id",
        (F.col("order_id") % 5 + 1).cast("string").alias("review_score"),
        F.lit(None).cast("timestamp_ntz").alias("review_creation_date"),
    )
    return {k: v.cache() for k, v in dict(items=items, orders=orders, products=products, translation=translation,
                                           customers=customers, reviews=reviews).items()}


@pytest.fixture(params=["skew_join", "no_aqe"])
def plan_mode(request, spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true" if request.param == "skew_join" else "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def pdf(df):
    return df.toPandas()


def test_marts_with_hot_keys(spark, frames, plan_mode):
    items = pdf(frames["items"])
    assert (items.product_id == HOT).sum() == N // 3
    got = pdf(gold.sales_by_product(frames["items"])).set_index("product_id").sort_index()
    exp = items.groupby("product_id").agg(units_sold=("order_item_id", "count"), product_revenue=("price", "sum"))
    assert got.units_sold.tolist() == exp.units_sold.tolist()
    assert got.product_revenue.tolist() == exp.product_revenue.tolist()

    om = pdf(gold.order_metrics(frames["items"])).set_index("order_id").sort_index()
    exp_om = items.groupby("order_id").agg(n=("order_item_id", "count"), v=("price", "sum"))
    assert om.item_count.tolist() == exp_om.n.tolist() and om.total_order_value.tolist() == exp_om.v.tolist()

    cat = pdf(gold.sales_by_category(frames["items"], frames["products"], frames["translation"]))
    prods = pdf(frames["products"])
    joined = items.merge(prods, on="product_id", how="left")
    exp_cat = joined.groupby("product_category_name").agg(units=("order_item_id", "count"), rev=("price", "sum"))
    got_cat = cat.set_index("product_category_name").sort_index()
    assert got_cat.units_sold.tolist() == exp_cat.units.tolist()
    assert got_cat.category_revenue.tolist() == exp_cat.rev.tolist()
    assert got_cat.loc["hot", "product_category_name_english"] == "hot_en"


def test_pair_grain_and_customer_grain_queries_with_hot_keys(spark, frames, plan_mode):
    items = pdf(frames["items"])
    dim_products = gold.dim_products(frames["products"], frames["translation"])
    vol = pdf(product.category_order_volume(frames["items"], dim_products)).set_index("category")
    dp = pdf(dim_products)
    j = items.merge(dp, on="product_id").dropna(subset=["product_category_name_english"])
    exp = j.groupby("product_category_name_english").order_id.nunique()
    assert vol.orders.sort_index().tolist() == exp.sort_index().tolist()
    hot_avg = j[j.product_category_name_english == "hot_en"].price
    cents = sum(int(p * 100) for p in hot_avg)
    assert vol.loc["hot_en", "average_price"] == ((2 * cents + len(hot_avg)) // (2 * len(hot_avg))) / 100

    fact_orders = gold.fact_orders(frames["orders"], frames["items"])
    hist = pdf(customer.orders_per_customer(fact_orders, frames["customers"])).set_index("orders_placed")
    orders = pdf(frames["orders"]).merge(pdf(frames["customers"]), on="customer_id")
    exp_hist = orders.groupby("customer_unique_id").order_id.nunique().value_counts().sort_index()
    assert hist.customers.tolist() == exp_hist.tolist()
    assert hist.index.tolist() == exp_hist.index.tolist()

    poor = pdf(review.poor_review_categories(frames["reviews"], frames["items"], dim_products)).set_index("category")
    r = pdf(frames["reviews"]).assign(score=lambda d: d.review_score.astype(float))
    pairs = (r.merge(j[["order_id", "product_category_name_english"]].drop_duplicates(), on="order_id")
             [["review_id", "product_category_name_english", "score"]].drop_duplicates())
    exp_poor = pairs.groupby("product_category_name_english").score.agg(["count", "mean"])
    assert poor.reviews.sort_index().tolist() == exp_poor["count"].sort_index().tolist()
    assert poor.average_rating.sort_index().tolist() == pytest.approx(exp_poor["mean"].sort_index().tolist(), rel=1e-12)
