"""Value buckets: what a value histogram groups by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.text import canonical_text
from tabscope.functions.types import is_numeric

# Bucket labels and widths of the profile tables.
NULL_MARK = "##"
VALUE_CHARS = 100  # width of values and patterns in the profile tables, for ``value_chars``
PREFIX_CHARS = 6
ZERO_LABEL = "0"
RANGES = (
    (1, 100, "1~100"),
    (101, 1000, "101~1000"),
    (1001, 10000, "1001~10000"),
    (10001, 100000, "10001~100000"),
    (100001, 1000000, "100001~1000000"),
)
NEGATIVE_LABEL = "0미만"
OTHER_LABEL = "1000000초과"

_CALENDAR = (T.DateType, T.TimestampType, T.TimestampNTZType)


def leading(text: Column, chars: int | None) -> Column:
    """The first ``chars`` characters, or the whole text for ``None``."""
    return text if chars is None else F.substring(text, 1, chars)


def range_label(number: Column, rounded: bool = False) -> Column:
    """Range bucket of a number.

    The ranges are closed and integral, so a fraction between two of them (0.5,
    100.5) belongs to none and gets the last label. ``rounded=True`` rounds first,
    as sources do that cast to a scale-0 decimal before comparing.
    """
    value = F.round(number) if rounded else number
    label = F.when(number.isNull(), NULL_MARK).when(value == 0, ZERO_LABEL)
    for low, high, name in RANGES:
        label = label.when(value.between(low, high), name)
    return label.when(value < 0, NEGATIVE_LABEL).otherwise(OTHER_LABEL)


def value_bucket(
    col: Column,
    dtype: T.DataType,
    mode: str,
    *,
    decimals: int | None = None,
    value_chars: int | None = None,
    months: bool = False,
    rounded: bool = False,
) -> Column:
    """Bucket of one value under mode ``Y`` (value), ``A`` (period) or ``B`` (range).

    ``B`` on a column that is not a number falls back to the prefix of ``A``.
    ``A`` takes the leading characters of the text form; with ``months`` a date or
    timestamp gives its year and month instead. NULL is a bucket of its own. Values are
    kept whole unless ``value_chars`` cuts them.
    """
    if mode not in ("Y", "A", "B"):
        raise ValueError(f"unknown value mode {mode!r}; expected Y, A or B")
    if mode == "B" and is_numeric(dtype):
        return range_label(col, rounded)
    if mode == "A" and months and isinstance(dtype, _CALENDAR):
        return F.coalesce(F.date_format(col, "yyyyMM"), F.lit(NULL_MARK))
    text = F.coalesce(canonical_text(col, dtype, decimals), F.lit(NULL_MARK))
    return leading(text, value_chars if mode == "Y" else PREFIX_CHARS)
