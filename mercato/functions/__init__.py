"""Column-level functions: money, text, formatting, coercion."""

from mercato.functions.columns import (  # noqa: F401
    ColumnCollisionError,
    clean_columns,
    if_columns,
    resolve_column,
    to_datetime,
    to_number,
)
from mercato.functions.formatting import format_count, format_money  # noqa: F401
from mercato.functions.money import (  # noqa: F401
    MONEY,
    exact_mean,
    money_avg,
    money_sum,
    money_sum_or_zero,
    to_money,
    to_output,
    try_money,
)
from mercato.functions.text import id_prefix, normalise_text, title_case  # noqa: F401
