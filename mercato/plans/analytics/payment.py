"""Payment analytics: value, usage and instalment behaviour per payment type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import to_number
from mercato.functions.money import exact_mean, money_avg, money_sum_or_zero


def _numeric(df: DataFrame, col: str):
    return to_number(col) if df.schema[col].dataType.simpleString() == "string" else F.col(col)


def payment_kpis(fact_payments: DataFrame) -> DataFrame:
    return fact_payments.agg(
        money_sum_or_zero("payment_value").alias("payment_value"),
        F.count(F.lit(1)).alias("payment_records"),
        exact_mean(_numeric(fact_payments, "payment_installments")).alias("avg_installments"),
    )


def payment_value_by_type(fact_payments: DataFrame) -> DataFrame:
    out = (
        fact_payments.filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(money_sum_or_zero("payment_value").alias("payment_value"))
    )
    return out.orderBy(F.col("payment_value").desc(), F.col("payment_type").asc())


def payment_usage_by_type(fact_payments: DataFrame) -> DataFrame:
    out = (
        fact_payments.filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return out.orderBy(F.col("count").desc(), F.col("payment_type").asc())


def payment_behaviour(fact_payments: DataFrame) -> DataFrame:
    """Per (type, instalments): payments, half-up average value, share of all payments.

    The share's denominator is a scalar subquery (one value computed from the
    grouped result), so no window gathers the rows into a single partition.
    """
    grouped = (
        fact_payments.filter(F.col("payment_type").isNotNull() & F.col("payment_installments").isNotNull())
        .groupBy("payment_type", "payment_installments")
        .agg(F.count(F.lit(1)).alias("payments"), money_avg("payment_value").alias("avg_payment_value"))
    )
    total = grouped.agg(F.sum("payments")).scalar()
    out = grouped.withColumn("share", F.col("payments").cast("double") / total)
    return out.orderBy("payment_type", "payment_installments")
