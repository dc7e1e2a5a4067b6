"""Money as exact decimals.

Amounts are ``DECIMAL(18,2)`` inside the library. Sums stay decimal (exact and
independent of partitioning / summation order), averages are computed in integer
cents with half-up rounding, and the result is cast to ``double`` only at the
output edge (:func:`to_output`). Floating sums would change in their last bits
with the partition layout, which makes results irreproducible at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: str | Column) -> Column:
    """Strict cast to DECIMAL(18,2) (use :func:`try_money` for dirty text)."""
    return _col(c).cast(MONEY)


def try_money(c: str | Column) -> Column:
    """Cast to DECIMAL(18,2); unparseable or out-of-range values become NULL."""
    return _col(c).try_cast(MONEY)


def int_div(a: Column, b: Column) -> Column:
    """SQL ``div``: integer division truncating toward zero (NULL if ``b`` is NULL)."""
    return F.call_function("div", a, b)


def money_sum(c: str | Column) -> Column:
    """Exact sum rounded to cents (gold marts: NULL when every input is NULL)."""
    return F.round(F.sum(_col(c)), 2)


def money_sum_or_zero(c: str | Column) -> Column:
    """Exact sum where an empty / all-null input gives 0 (dashboard KPI rule)."""
    return F.coalesce(F.sum(_col(c)), F.lit(0).cast(MONEY))


def avg_cents_half_up(sum_cents: Column, n: Column) -> Column:
    """Average of cent amounts rounded half away from zero, as a double in units.

    ``sign(s) * ((2*|s| + n) div (2*n)) / 100`` in exact arithmetic, so every
    engine agrees; NULL when ``n`` is 0. ``sum_cents`` should be a DECIMAL (the
    exact money sum times 100): a 64-bit cent total of a very large table can
    overflow, a DECIMAL(38,2) cannot below 10^36.
    """
    quotient = int_div(F.lit(2) * F.abs(sum_cents) + n, F.lit(2) * F.nullif(n, F.lit(0)))
    return (F.signum(sum_cents).cast("bigint") * quotient).cast("double") / F.lit(100)


def money_avg(c: str | Column) -> Column:
    """``round(avg(c), 2)`` with exact half-up rounding on cents (``c`` is DECIMAL money)."""
    x = _col(c)
    return avg_cents_half_up(F.sum(x) * 100, F.count(x))


def exact_mean(c: str | Column) -> Column:
    """Mean as ``double(sum) / count``: the sum is exact, then one IEEE division."""
    x = _col(c)
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))


def to_output(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double: the library's output edge."""
    cols = []
    for f in df.schema.fields:
        ref = F.col(f"`{f.name}`")
        cols.append(ref.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else ref)
    return df.select(*cols)
