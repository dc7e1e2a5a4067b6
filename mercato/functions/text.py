"""String helpers expressed with built-in Column functions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a run of letters or a run of non-letters. Python's ``str.title``
# starts a new word after any non-letter, so each letter run is capitalised.
WORD_RUNS = r"\p{L}+|[^\p{L}]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: str | Column) -> Column:
    """Python ``str.title()`` semantics: "SANTA d'oeste" -> "Santa D'Oeste".

    Spark's ``initcap`` only starts words after whitespace, so the value is split
    into letter / non-letter runs and every run is capitalised.
    """
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD_RUNS), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def normalise_text(c: str | Column) -> Column:
    """``lower(trim(c))``: join keys compared case- and padding-insensitively."""
    return F.lower(F.trim(_col(c)))


def id_prefix(c: str | Column, n: int = 12) -> Column:
    """First ``n`` characters of the id as text (fallback label)."""
    return F.substring(_col(c).cast("string"), 1, n)
