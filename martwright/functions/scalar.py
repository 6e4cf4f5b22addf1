"""Scalar helpers shared by the models."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: stands in for NULL inside a surrogate key, so NULL and '' give different keys.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Every character Python's str.split() and str.strip() treat as white space, and the same set as the
# inside of a regular expression class.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WHITESPACE_CLASS = "".join(rf"\x{{{ord(c):X}}}" for c in WHITESPACE)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the text of the parts joined by ``-``; NULL parts get a fixed token."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def safe_divide(numerator: Column | str, denominator: Column | str, default=0) -> Column:
    """``numerator / denominator``, or the default where the denominator is 0 or NULL."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d.isNull() | (d == 0), F.lit(default)).otherwise(n / d)


def cents_to_dollars(cents: Column | str, precision: int = 2) -> Column:
    return F.round(_col(cents) / F.lit(Decimal("100.0")), precision)


def to_cents(amount: Column | str) -> Column:
    """Whole hundredths as a long, rounded half away from zero as a decimal of two places.

    Adding up longs is several times cheaper than adding up wide decimals, and as exact. A sum of
    hundredths has room for 92 quadrillion units before it raises. Below a hundred billion a double is
    within 0.002 of the hundredths, so rounding it gives them, without an object per wide product.
    """
    exact = _col(amount).cast("decimal(18,2)")
    near = exact.cast("double")
    cents = F.rint(near * F.lit(100.0)).cast("long")
    return F.when(F.abs(near) < F.lit(1e11), cents).otherwise((exact * F.lit(100)).cast("long"))


def from_cents(cents: Column | str, kind: str = "decimal(18,2)") -> Column:
    return (_col(cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(kind)


def round_cents(value: str, unit: int) -> Column:
    """Whole-number quotient of a long expression by a unit, rounded half away from zero."""
    half = unit // 2
    return F.expr(
        f"if({value} >= 0, ({value} + {half}) div {unit}, -(({half} - ({value})) div {unit}))"
    )


def round_ratio(numerator: Column | str, denominator: Column | str, scale: int) -> Column:
    """Decimal quotient rounded half away from zero; NULL where the denominator is 0.

    The operand types give the quotient 18 decimal places, so the final rounding sees every digit
    that can matter for amounts in cents.
    """
    d = _col(denominator).cast("decimal(20,2)")
    return F.round(_col(numerator).cast("decimal(22,4)") / F.nullif(d, F.lit(0)), scale)


def flag(predicate: Column) -> Column:
    """Two-valued flag: an unknown predicate counts as false."""
    return F.when(predicate, F.lit(True)).otherwise(F.lit(False))


def buckets(value: Column, steps: list[tuple], otherwise: str) -> Column:
    """Label of the first step whose lower bound the value reaches."""
    label = None
    for bound, name in steps:
        reached = value >= F.lit(bound)
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return label.otherwise(otherwise)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.date_diff(_col(end), _col(start)).cast("long")


def month_of(date: Column | str) -> Column:
    return F.trunc(_col(date), "MM")


def quarter_of(date: Column | str) -> Column:
    return F.trunc(_col(date), "quarter")


def year_of(date: Column | str) -> Column:
    return F.year(_col(date)).cast("long")


def day_offset(date: Column, years: int = 0, days: int = 0) -> Column:
    """The date moved by whole years (29 February falls back to the 28th), then by days."""
    return F.date_add(F.add_months(date, 12 * years), days)


def strip_prefix(name: str) -> str:
    """Column name without its one- or two-letter source prefix, in lower case."""
    return re.sub(r"^[a-z]{1,2}_", "", name.lower())


def word_count(text: Column | str) -> Column:
    """Number of words between white space; 0 for empty and NULL text."""
    words = F.regexp_count(_col(text), F.lit(f"[^{WHITESPACE_CLASS}]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def has_words(text: Column | str, n: int) -> Column:
    """Whether the text has at least ``n`` words: the answer of counting them all, but long texts
    are settled at their n-th word. Anchored and without backtracking, so one very long word costs
    no more than its length."""
    if n <= 0:
        return F.lit(True)
    space, word = f"[{WHITESPACE_CLASS}]", f"[^{WHITESPACE_CLASS}]"
    pattern = f"^{space}*+(?:{word}++{space}++){{{n - 1}}}{word}"
    return F.coalesce(_col(text).rlike(pattern), F.lit(False))


def text_length(text: Column | str) -> Column:
    """Length without leading and trailing white space; 0 for NULL."""
    return F.coalesce(F.length(F.trim(_col(text), F.lit(WHITESPACE))), F.lit(0)).cast("long")


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def value_codes(value: str, kind: T.DataType) -> tuple[str, str]:
    """SQL of two longs that tell the values of an expression of a type apart.

    XXH64 maps values of up to 8 bytes one to one, so the first long is exact there and the second is 0.
    Other values take a second hash with another seed: 128 bits together.
    """
    narrow = kind.precision <= 18 if isinstance(kind, T.DecimalType) else isinstance(kind, _FIXED_WIDTH)
    return f"xxhash64({value})", "0L" if narrow else f"xxhash64(7, {value})"
