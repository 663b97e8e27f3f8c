"""Type classes that decide how a column is profiled.

A column is described either by its Spark type (lake tables) or by the type name
a vendor catalog reports for it (dictionary rows). Both forms are accepted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Catalog type names that are never profiled (exact match, any case).
UNSTRUCTURED_NAMES = (
    "TEXT", "NTEXT", "IMAGE", "XML", "XMLTYPE",
    "BLOB", "CLOB", "NCLOB", "BFILE", "LONG", "LONG RAW", "RAW",
    "BYTEA", "JSON", "JSONB",
)


_UNSTRUCTURED_SPARK = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


def is_unstructured(dtype: T.DataType, vendor_type: str | None = None) -> bool:
    """True when neither statistics nor histograms make sense for the column."""
    if isinstance(dtype, _UNSTRUCTURED_SPARK):
        return True
    return vendor_type is not None and vendor_type.upper() in UNSTRUCTURED_NAMES


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_character(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def character_type_name(type_name: Column) -> Column:
    """Predicate on dictionary rows: does the catalog type name mean text?"""
    upper = F.upper(type_name)
    return upper.contains("CHAR") | (upper == "STRING")
