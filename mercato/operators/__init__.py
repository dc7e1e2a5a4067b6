"""Reusable DataFrame -> DataFrame operators."""

from mercato.operators.clean import (  # noqa: F401
    dedupe_by_key,
    dedupe_rows,
    drop_null,
    fill_unknown,
    low_rating,
    normalise_columns,
    parse_timestamps,
    project,
)
from mercato.operators.shape import (  # noqa: F401
    fill_month_gaps,
    month_end_ts,
    month_start,
    one_row,
    top_n,
)
