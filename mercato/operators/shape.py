"""Ordering, top-k and month spines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranked(df: DataFrame, metric: str, key: str | Sequence[str], ascending: bool = False) -> list[Column]:
    """Sort keys: metric (desc, NULLs last) then the key(s) ascending as the tie-break."""
    keys = [key] if isinstance(key, str) else list(key)
    m = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return [m] + [F.col(k).asc_nulls_last() for k in keys]


def top_n(df: DataFrame, metric: str, key: str | Sequence[str], n: int, ascending: bool = False) -> DataFrame:
    """Deterministic top-k: metric order, ties broken by key (TakeOrderedAndProject)."""
    return df.orderBy(*ranked(df, metric, key, ascending)).limit(n)


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE."""
    x = F.col(c) if isinstance(c, str) else c
    return F.trunc(x.cast("date"), "month")


def month_end_ts(c: str | Column) -> Column:
    """Month-end label as a midnight timestamp (pandas ``resample('ME')`` labels)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.last_day(x).cast("timestamp_ntz")


def fill_month_gaps(agg: DataFrame, month_col: str, fill: Mapping[str, object]) -> DataFrame:
    """Add every month between the first and last month of ``agg`` (a DATE month start).

    The spine comes from the min/max of the already aggregated frame, so it is
    bounded by the number of months, not by the data volume; months with no row
    get ``fill`` values.
    """
    bounds = agg.agg(F.min(month_col).alias("_lo"), F.max(month_col).alias("_hi"))
    spine = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias(month_col))
    out = spine.join(agg, month_col, "left")
    return out.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(agg.schema[c].dataType)) for c, v in fill.items()}
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates with distinct column names into one row.

    A union of the rows followed by a per-column ``max`` (each column is set in
    exactly one input row), so no join is needed to put scalar KPIs side by side.
    """
    if len(frames) == 1:
        return frames[0]
    names: list[str] = []
    for f in frames:
        names += [c for c in f.columns if c not in names]
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f, allowMissingColumns=True)
    return union.agg(*[F.max(F.col(c)).alias(c) for c in names])
