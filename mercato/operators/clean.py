"""Cleaning, projection and de-duplication operators (DataFrame -> DataFrame)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import to_datetime
from mercato.functions.text import normalise_text

# The order timestamp columns parsed by the silver job.
ORDER_TIMESTAMP_COLUMNS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in cols])


def parse_timestamps(df: DataFrame, cols: Iterable[str] = ORDER_TIMESTAMP_COLUMNS) -> DataFrame:
    """Parse the named columns that exist to timestamps; junk becomes NULL."""
    present = {c: to_datetime(c) for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def normalise_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``lower(trim(c))`` for each named column that exists."""
    present = {c: normalise_text(c) for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the survivor is the smallest row by ``order`` then the rest.

    Deterministic form of ``dropDuplicates(keys)``. Written as ``min(struct)`` in
    a grouped aggregate rather than ``row_number`` over a window: the aggregate
    combines map-side, so a key that holds a large share of the rows is reduced
    in every task instead of being sorted inside one.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    ordered = list(order or []) + [c for c in rest if c not in (order or [])]
    survivor = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_survivor")
    out = df.groupBy(*keys).agg(survivor).select(*keys, *[F.col(f"_survivor.{c}").alias(c) for c in ordered])
    return out.select(*df.columns)


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def fill_unknown(df: DataFrame, col: str, value: str = "unknown") -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def low_rating(df: DataFrame, score_col: str = "review_score", max_score: int = 2) -> DataFrame:
    """Rows whose numeric score is <= ``max_score`` (NULL scores excluded)."""
    return df.filter(F.col(score_col) <= F.lit(max_score))


def not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
