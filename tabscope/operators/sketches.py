"""Distinct counts by mergeable sketches: an estimate with a stated bound, opt-in.

A sketch is a few kilobytes a column whatever the table holds, so sketches of many loads
can be kept and united where exact counts would read everything again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.text import distinct_key
from tabscope.operators.column_stats import column_numbers
from tabscope.operators.shapes import long_form, source_column, union_all
from tabscope.plans.spec import COLUMN_KEY, ColumnRef, ProfileInput, name_columns

#: Registers are 2^LG_K; the relative standard error of united sketches is 1.04 / sqrt(2^LG_K).
LG_K = 12
#: Standard errors of the stated bound.
SIGMAS = 3.0


def bound(lg_k: int = LG_K) -> float:
    """The stated relative error: exceeded by about one estimate in 370."""
    return SIGMAS * 1.04 / math.sqrt(1 << lg_k)


def _key(r: ColumnRef) -> tuple[str, Column]:
    """A key sketches take, equal exactly when the values are."""
    dtype = r.source.dtype(r.column.col_nm)
    kind, key = distinct_key(source_column(r), dtype)
    if kind in ("string", "bigint"):
        return kind, key
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        key = F.when(key == 0, F.lit(0.0).cast(dtype)).otherwise(key)  # -0.0 is 0.0
    return "string", key.cast("string")


def sketch_rows(
    groups: Sequence[Sequence[ColumnRef]],
    with_columns: Sequence[str] = (),
    lg_k: int = LG_K,
) -> DataFrame:
    """(``ref``, ``with_columns``, ``sketch``): sketches combine on the map side."""
    families: dict[str, list[DataFrame]] = {}
    for group in groups:
        keyed: dict[str, list[tuple[ColumnRef, Column]]] = {}
        for r in group:
            kind, key = _key(r)
            keyed.setdefault(kind, []).append((r, key))
        for kind, members in keyed.items():
            keys = {r.ref: k for r, k in members}
            rows = long_form([r for r, _ in members], lambda r: keys[r.ref], "key", with_columns)
            families.setdefault(kind, []).append(rows)
    return union_all(
        union_all(frames).groupBy("ref", *with_columns).agg(F.hll_sketch_agg("key", lg_k).alias("sketch"))
        for frames in families.values()
    )


def distinct_sketches(inputs: Sequence[ProfileInput], lg_k: int = LG_K) -> DataFrame:
    """A sketch of every structured column."""
    groups = column_numbers(inputs)
    return name_columns(sketch_rows(groups, lg_k=lg_k), groups)


def union_sketches(sketches: DataFrame, keys: Sequence[str] = COLUMN_KEY) -> DataFrame:
    """Sketches of several loads as one a column."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``col_kind`` as estimated, with the lowest and highest count inside the bound."""
    found = F.hll_sketch_estimate("sketch")
    off = bound(lg_k)
    return sketches.withColumns(
        {
            "col_kind": found,
            "least_kind": F.floor(found / (1 + off)).cast("bigint"),
            "most_kind": F.ceil(found / (1 - off)).cast("bigint"),
        }
    ).drop("sketch")
