"""Display text for KPI values, computed as Column expressions.

Money text is built from integer cents with half-up rounding, so it is exact
and engine-independent (Python's float formatting rounds the binary value
half-even; that difference only shows on exact half-way amounts such as
$1,250.00 -> "$1.3K" here, "$1.2K" in Python; see SURVEY T22).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercato.functions.money import MONEY, int_div

# Text shown for a missing value, and the unit thresholds in cents.
MISSING = "—"
MILLION_CENTS = 100_000_000
THOUSAND_CENTS = 100_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lpad_int(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def format_money(c: str | Column) -> Column:
    """NULL -> "—"; >= 1M -> "$x.xxM"; >= 1K -> "$x.xK"; else "$x.xx"; sign after "$"."""
    amount = _col(c).cast(MONEY)
    cts = (amount * 100).cast("bigint")
    a = F.abs(cts)
    sign = F.when(cts < 0, F.lit("-")).otherwise(F.lit(""))
    # amount in hundredths of a million / tenths of a thousand, rounded half up
    hundredths_m = int_div(F.lit(2) * a + F.lit(MILLION_CENTS // 100), F.lit(2 * MILLION_CENTS // 100))
    tenths_k = int_div(F.lit(2) * a + F.lit(THOUSAND_CENTS // 10), F.lit(2 * THOUSAND_CENTS // 10))
    millions = F.concat(
        F.lit("$"), sign, int_div(hundredths_m, F.lit(100)).cast("string"), F.lit("."),
        _lpad_int(hundredths_m % 100, 2), F.lit("M"),
    )
    thousands = F.concat(
        F.lit("$"), sign, int_div(tenths_k, F.lit(10)).cast("string"), F.lit("."),
        (tenths_k % 10).cast("string"), F.lit("K"),
    )
    units = F.concat(
        F.lit("$"), sign, int_div(a, F.lit(100)).cast("string"), F.lit("."), _lpad_int(a % 100, 2)
    )
    return (
        F.when(amount.isNull(), F.lit(MISSING))
        .when(a >= MILLION_CENTS, millions)
        .when(a >= THOUSAND_CENTS, thousands)
        .otherwise(units)
    )


def format_count(c: str | Column) -> Column:
    """NULL -> "—"; else truncate toward zero and group thousands: 1234.9 -> "1,234"."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(MISSING)).otherwise(F.format_number(x.cast("bigint"), 0))


def format_rating(c: str | Column) -> Column:
    """"x.xx / 5" (display only; JVM half-up on the shortest decimal form)."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(MISSING)).otherwise(F.format_string("%.2f / 5", x.cast("double")))


def format_percent(c: str | Column) -> Column:
    """"x.x%" (display only)."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(MISSING)).otherwise(F.format_string("%.1f%%", x.cast("double")))


def format_one_decimal(c: str | Column) -> Column:
    """"x.x" (display only), e.g. average installments."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(MISSING)).otherwise(F.format_string("%.1f", x.cast("double")))
