"""Column -> Column helpers. All are built-in Spark expressions and stay inside code generation."""

from martwright.functions.scalar import (
    buckets,
    cents_to_dollars,
    day_offset,
    days_between,
    flag,
    from_cents,
    has_words,
    month_of,
    quarter_of,
    round_cents,
    round_ratio,
    safe_divide,
    strip_prefix,
    surrogate_key,
    text_length,
    to_cents,
    value_codes,
    word_count,
    year_of,
)

__all__ = [
    "buckets",
    "cents_to_dollars",
    "day_offset",
    "days_between",
    "flag",
    "from_cents",
    "has_words",
    "month_of",
    "quarter_of",
    "round_cents",
    "round_ratio",
    "safe_divide",
    "strip_prefix",
    "surrogate_key",
    "text_length",
    "to_cents",
    "value_codes",
    "word_count",
    "year_of",
]
