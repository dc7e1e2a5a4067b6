"""Column-name handling and tolerant type coercion (plan-time Python over ``df.columns``)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ColumnCollisionError(ValueError):
    """Two source columns normalise to the same name."""


def clean_name(name: str) -> str:
    return name.strip().lower()


def clean_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name; refuse names that collide."""
    cleaned = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, new in zip(df.columns, cleaned):
        if new in seen:
            raise ColumnCollisionError(f"columns {seen[new]!r} and {raw!r} both clean to {new!r}")
        seen[new] = raw
    return df.toDF(*cleaned)


def resolve_column(df: DataFrame, candidates: Sequence[str], strict: bool = False) -> str | None:
    """First candidate present (case-insensitive), else first substring match.

    Exact matches over all candidates win before any substring match. With
    ``strict=True`` only exact matches count. A frame with no columns resolves
    nothing. (The dashboard also returned nothing for an empty frame; deciding
    emptiness needs a Spark job, so emptiness is left to the query itself.)
    """
    if not df.columns:
        return None
    lower_map: dict[str, str] = {}
    for c in df.columns:
        lower_map.setdefault(c.lower(), c)
    for cand in candidates:
        if cand.lower() in lower_map:
            return lower_map[cand.lower()]
    if strict:
        return None
    for cand in candidates:
        for c in df.columns:
            if cand.lower() in c.lower():
                return c
    return None


def conform(df: DataFrame, wanted: Mapping[str, Sequence[str]], numbers: Iterable[str] = ()) -> DataFrame:
    """Give each wanted column its name: if no column has it, the one that its candidates resolve to
    (exactly, else by substring) is repeated under it. Text in a column of ``numbers`` is coerced to money.

    What resolves to nothing stays absent; :func:`has_columns` then says so.
    """
    present = {c.lower() for c in df.columns}
    found = {}
    for name, candidates in wanted.items():
        column = name if name.lower() in present else resolve_column(df, [name, *candidates])
        if column is None:
            continue
        if name in numbers and df.schema[_spelt(df, column)].dataType.simpleString() == "string":
            found[name] = F.col(column).try_cast("decimal(18,2)")
        elif name.lower() not in present:
            found[name] = F.col(column)
    return df.withColumns(found) if found else df


def _spelt(df: DataFrame, column: str) -> str:
    return next(c for c in df.columns if c.lower() == column.lower())


def has_columns(df: DataFrame, cols: Iterable[str]) -> bool:
    return all(c in df.columns for c in cols)


def if_columns(df: DataFrame, cols: Iterable[str], fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``fn`` only when every column in ``cols`` exists (plan-time test)."""
    return fn(df) if has_columns(df, cols) else df


def to_number(c: str | Column) -> Column:
    """Tolerant numeric coercion: text that is not a number becomes NULL."""
    x = F.col(c) if isinstance(c, str) else c
    return x.try_cast("double")


def to_datetime(c: str | Column, fmt: str | None = None) -> Column:
    """Tolerant timestamp parsing to a wall-clock ``TIMESTAMP_NTZ``; malformed values
    become NULL (ANSI-safe).

    Source timestamps carry no zone, so they are kept as local wall-clock values:
    the result does not depend on the session time zone.
    """
    x = F.col(c) if isinstance(c, str) else c
    text = x.cast("string")
    if fmt:
        return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    return text.try_cast("timestamp_ntz")
