"""Readable labels for products and sellers (typed equi-joins, NULL never matches)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import resolve_column
from mercato.functions.text import id_prefix, title_case
from mercato.operators.clean import dedupe_by_key

# Candidate column names, in the order they are tried.
PRODUCT_NAME_CANDIDATES = ("product_name", "product_name_english", "product_title", "product_category_name_english")
PRODUCT_CATEGORY_CANDIDATES = (
    "product_category_name_english", "category_name_english", "product_category_name", "category",
)
SELLER_CITY_CANDIDATES = ("seller_city", "city")
SELLER_STATE_CANDIDATES = ("seller_state", "state")
SELLER_NAME_CANDIDATES = ("seller_name", "name")


def product_label_lookup(products: DataFrame, strict: bool = True) -> DataFrame | None:
    """``product_id, product_label``: a name column if any, else the category; one row per id."""
    pid = resolve_column(products, ["product_id"], strict=strict)
    if pid is None:
        return None
    label = resolve_column(products, PRODUCT_NAME_CANDIDATES, strict=strict) or resolve_column(
        products, PRODUCT_CATEGORY_CANDIDATES, strict=strict
    )
    if label is None:
        return None
    lookup = products.select(F.col(pid).alias("product_id"), F.col(label).alias("product_label"))
    return dedupe_by_key(lookup, ["product_id"])


def add_product_labels(df: DataFrame, products: DataFrame | None, strict: bool = True) -> DataFrame:
    """Append ``product_label``; products without a label get the first 12 id characters."""
    pid = resolve_column(df, ["product_id"], strict=strict)
    if pid is None:
        return df
    lookup = product_label_lookup(products, strict=strict) if products is not None else None
    if lookup is None:
        return df.withColumn("product_label", id_prefix(pid))
    lookup = lookup.withColumnRenamed("product_id", "_label_pid")
    out = df.join(lookup, F.col(pid) == F.col("_label_pid"), "left").drop("_label_pid")
    return out.withColumn("product_label", F.coalesce(F.col("product_label"), id_prefix(pid)))


def seller_label_lookup(sellers: DataFrame, strict: bool = True) -> DataFrame | None:
    """``seller_id, seller_label``: name column, else "Title City, STATE", else the id prefix.

    NULL city/state parts become empty text, so a known seller always has a label.
    """
    sid = resolve_column(sellers, ["seller_id"], strict=strict)
    if sid is None:
        return None
    name = resolve_column(sellers, SELLER_NAME_CANDIDATES, strict=strict)
    city = resolve_column(sellers, SELLER_CITY_CANDIDATES, strict=strict)
    state = resolve_column(sellers, SELLER_STATE_CANDIDATES, strict=strict)
    if name is not None:
        label = F.col(name)
    elif city is not None or state is not None:
        parts = []
        if city is not None:
            parts.append(title_case(F.coalesce(F.col(city).cast("string"), F.lit(""))))
        if state is not None:
            parts.append(F.upper(F.coalesce(F.col(state).cast("string"), F.lit(""))))
        label = parts[0] if len(parts) == 1 else F.concat(parts[0], F.lit(", "), parts[1])
    else:
        label = id_prefix(sid)
    lookup = sellers.select(F.col(sid).alias("seller_id"), label.alias("seller_label"))
    return dedupe_by_key(lookup.filter(F.col("seller_id").isNotNull()), ["seller_id"])


def add_seller_labels(df: DataFrame, sellers: DataFrame | None, strict: bool = True) -> DataFrame:
    """Append ``seller_label``; sellers missing from the dimension get the id prefix."""
    sid = resolve_column(df, ["seller_id"], strict=strict)
    if sid is None:
        return df
    lookup = seller_label_lookup(sellers, strict=strict) if sellers is not None else None
    if lookup is None:
        return df.withColumn("seller_label", id_prefix(sid))
    lookup = lookup.withColumnRenamed("seller_id", "_label_sid")
    out = df.join(lookup, F.col(sid) == F.col("_label_sid"), "left").drop("_label_sid")
    return out.withColumn("seller_label", F.coalesce(F.col("seller_label"), id_prefix(sid)))
