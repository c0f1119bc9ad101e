"""Column-level building blocks (pure Spark expressions, no UDFs)."""

from strata.functions.casts import typed_cast
from strata.functions.dates import (
    date_key, day_name, day_of_week, is_month_end, is_month_start, is_weekend,
    key_to_date, month_name, week_of_year, year_month,
)
from strata.functions.hashing import raw_row_hash, row_hash
from strata.functions.text import clean_text, null_tokens_to_null

__all__ = [
    "typed_cast", "date_key", "day_name", "day_of_week", "is_month_end", "is_month_start",
    "is_weekend", "key_to_date", "month_name", "week_of_year", "year_month",
    "raw_row_hash", "row_hash", "clean_text", "null_tokens_to_null",
]
