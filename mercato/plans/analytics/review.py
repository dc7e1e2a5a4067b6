"""Review analytics: rating KPIs, distribution, low-rated reviews, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import resolve_column, to_number
from mercato.functions.money import exact_mean
from mercato.operators.shape import fill_month_gaps, month_end_ts, month_start
from mercato.plans.analytics.customer import customer_lookup
from mercato.plans.analytics.product import product_category_lookup

# Candidate column names.
SCORE_CANDIDATES = ("review_score", "rating", "score")
COMMENT_CANDIDATES = ("review_comment_message", "comment_message", "review_comment_title")


def numeric_score(fact_reviews: DataFrame) -> DataFrame:
    """Score coerced to a number (text such as "n/a" becomes NULL)."""
    score = resolve_column(fact_reviews, SCORE_CANDIDATES, strict=True)
    return fact_reviews.withColumn("_score", to_number(score))


def review_kpis(fact_reviews: DataFrame) -> DataFrame:
    return numeric_score(fact_reviews).agg(
        exact_mean("_score").alias("average_rating"),
        F.count(F.lit(1)).alias("review_records"),
        F.count("_score").alias("valid_ratings"),
    )


def rating_distribution(fact_reviews: DataFrame) -> DataFrame:
    out = (
        numeric_score(fact_reviews)
        .filter(F.col("_score").isNotNull())
        .groupBy(F.col("_score").alias("rating"))
        .agg(F.count(F.lit(1)).alias("reviews"))
    )
    return out.orderBy("rating")


def low_rating_reviews(fact_reviews: DataFrame, max_score: int = 2, n: int = 50) -> DataFrame:
    """First ``n`` reviews scored <= ``max_score`` (by score, then review id)."""
    scored = numeric_score(fact_reviews).filter(F.col("_score") <= F.lit(max_score))
    comment = resolve_column(fact_reviews, COMMENT_CANDIDATES, strict=True)
    score = resolve_column(fact_reviews, SCORE_CANDIDATES, strict=True)
    cols = [F.col("order_id"), F.col("_score").alias(score)] + ([F.col(comment)] if comment else [])
    ordered = scored.orderBy(F.col("_score").asc(), F.col("review_id").asc_nulls_last())
    return ordered.limit(n).select(*cols)


def review_trend(fact_reviews: DataFrame) -> DataFrame:
    """Reviews and mean score per month of review creation; empty months kept."""
    monthly = (
        numeric_score(fact_reviews)
        .filter(F.col("review_creation_date").isNotNull())
        .groupBy(month_start("review_creation_date").alias("_month"))
        .agg(F.count(F.lit(1)).alias("reviews"), exact_mean("_score").alias("average_rating"))
    )
    filled = fill_month_gaps(monthly, "_month", {"reviews": 0})
    return filled.select(month_end_ts("_month").alias("month"), "reviews", "average_rating").orderBy("month")


def poor_review_categories(
    fact_reviews: DataFrame, fact_order_items: DataFrame, dim_products: DataFrame, max_score: int = 2
) -> DataFrame:
    """Mean score and low-score share per category; each (review, category) counted once.

    Items are reduced to distinct (order, category) pairs before meeting the
    reviews, so an order with many items of one category does not repeat a review.
    """
    order_categories = (
        fact_order_items.select("order_id", "product_id")
        .distinct()
        .join(product_category_lookup(dim_products), "product_id", "inner")
        .filter(F.col("category").isNotNull())
        .select("order_id", "category")
        .distinct()
    )
    scored = numeric_score(fact_reviews).filter(F.col("_score").isNotNull()).select("review_id", "order_id", "_score")
    pairs = scored.join(order_categories, "order_id", "inner").select("review_id", "category", "_score").distinct()
    out = pairs.groupBy("category").agg(
        F.count(F.lit(1)).alias("reviews"),
        exact_mean("_score").alias("average_rating"),
        (F.count(F.when(F.col("_score") <= max_score, 1)).cast("double") / F.count(F.lit(1))).alias("low_share"),
    )
    return out.orderBy(F.col("average_rating").asc(), F.col("category").asc())


def review_by_location(fact_reviews: DataFrame, fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Review volume and mean score per customer state (lowest first).

    Scores are summed per order, then per customer, before the state lookup,
    so every join runs at order or customer grain.
    """
    per_order = (
        numeric_score(fact_reviews)
        .filter(F.col("_score").isNotNull())
        .groupBy("order_id")
        .agg(F.sum("_score").alias("_s"), F.count("_score").alias("_n"))
    )
    order_customers = fact_orders.select("order_id", "customer_id").distinct()
    per_customer = (
        per_order.join(order_customers, "order_id", "inner")
        .groupBy("customer_id")
        .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    )
    states = customer_lookup(dim_customers, ["customer_state"])
    located = per_customer.join(states, "customer_id", "inner").filter(F.col("customer_state").isNotNull())
    agg = located.groupBy("customer_state").agg(F.sum("_n").alias("reviews"), F.sum("_s").alias("_s"))
    out = agg.select("customer_state", "reviews", (F.col("_s").cast("double") / F.col("reviews")).alias("average_rating"))
    return out.orderBy(F.col("average_rating").asc(), F.col("customer_state").asc())
