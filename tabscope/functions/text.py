"""Text forms of a typed column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.types import is_character

_FRACTIONAL = (T.FloatType, T.DoubleType)

# Longer values enter the distinct pass as a digest, so that counting distinct
# documents shuffles 66 bytes per value instead of the document.
DIGEST_OVER_BYTES = 64

# Fixed value: the key type that all integers share.
INTEGER_KEY = "bigint"


def canonical_text(col: Column, dtype: T.DataType, decimals: int | None = None) -> Column:
    """The text a profile shows for a value.

    With ``decimals`` a float or double is printed as a plain decimal of that
    scale; values outside the decimal range (and NaN, Infinity) keep Spark's own form.
    """
    if is_character(dtype):
        return col
    if isinstance(dtype, _FRACTIONAL) and decimals is not None:
        plain = col.try_cast(T.DecimalType(38, decimals)).cast("string")
        return F.coalesce(plain, col.cast("string"))
    return col.cast("string")


def distinct_key(col: Column, dtype: T.DataType) -> tuple[str, Column]:
    """Key type and a key that is equal for two values exactly when the values are.

    Everything but text keeps its own type (integers share one), so that counting
    builds no strings. Grouping takes -0.0 for 0.0 and all NaN for one value. Raw text
    keys are at most 64 bytes and digests are 66, so the two can not meet.
    """
    if is_character(dtype):
        digest = F.concat(F.lit("h:"), F.sha2(col, 256))
        return "string", F.when(F.octet_length(col) > DIGEST_OVER_BYTES, digest).otherwise(col)
    if isinstance(dtype, T.IntegralType):
        return INTEGER_KEY, col.cast(INTEGER_KEY)
    return dtype.simpleString(), col
