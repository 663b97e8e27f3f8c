"""Value level: histograms of bucketed values and the top sample values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.buckets import NULL_MARK, value_bucket
from tabscope.operators.shapes import long_form, source_column, union_all
from tabscope.plans.spec import COLUMN_KEY, ColumnRef, ProfileInput, name_columns, number_columns

# How sample values are picked and joined.
SAMPLE_VALUES = 3
SAMPLE_SEPARATOR = " | "


def value_histogram(
    inputs: Sequence[ProfileInput],
    *,
    strategy: str = "unpivot",
    value_chars: int | None = None,
    months: bool = False,
    rounded: bool = False,
) -> DataFrame:
    """(column, ``col_val``, ``col_val_cnt``); see :func:`numbered_histogram`."""
    return name_columns(
        *numbered_histogram(
            inputs, strategy=strategy, value_chars=value_chars, months=months, rounded=rounded
        )
    )


def numbered_histogram(
    inputs: Sequence[ProfileInput],
    *,
    strategy: str = "unpivot",
    value_chars: int | None = None,
    months: bool = False,
    rounded: bool = False,
) -> tuple[DataFrame, list[list[ColumnRef]]]:
    """(``ref``, ``col_val``, ``col_val_cnt``) for every flagged column of every table.

    What is derived from it can stay on the short key until a row per column is left.

    ``unpivot``     one scan per table and one shuffle for all tables; map-side
                    combine absorbs hot values and the NULL bucket.
    ``joint``       groups each table by all its buckets together first. Better only
                    when the combinations are few.
    ``per_column``  one aggregation and one scan per column.

    All three give the same rows. Values are whole unless ``value_chars`` cuts them.
    """

    bucket = _bucket_of(value_chars, months, rounded)
    groups = number_columns((source, source.value_columns()) for source in inputs)
    if not groups:
        raise ValueError("no column is flagged for a value histogram")
    counted = F.count(F.lit(1)).alias("col_val_cnt")
    if strategy == "unpivot":
        rows = union_all(long_form(group, bucket, "col_val") for group in groups)
        histogram = rows.groupBy("ref", "col_val").agg(counted)
    elif strategy == "joint":
        histogram = union_all(_joint(group, bucket) for group in groups)
    elif strategy == "per_column":
        histogram = union_all(
            long_form([r], bucket, "col_val").groupBy("ref", "col_val").agg(counted)
            for group in groups
            for r in group
        )
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return histogram, groups


def _bucket_of(
    value_chars: int | None, months: bool, rounded: bool
) -> Callable[[ColumnRef], Column]:
    def bucket(r: ColumnRef) -> Column:
        return value_bucket(
            source_column(r),
            r.source.dtype(r.column.col_nm),
            r.column.value_mode,
            decimals=r.column.decimals,
            value_chars=value_chars,
            months=months,
            rounded=rounded,
        )

    return bucket


def bucket_rows(
    groups: Sequence[Sequence[ColumnRef]],
    with_columns: Sequence[str] = (),
    *,
    value_chars: int | None = None,
    months: bool = False,
    rounded: bool = False,
) -> DataFrame:
    """(``ref``, ``col_val``, ``with_columns``): the buckets of all rows, not yet counted."""
    bucket = _bucket_of(value_chars, months, rounded)
    return union_all(long_form(group, bucket, "col_val", with_columns) for group in groups)


def _joint(group: Sequence[ColumnRef], bucket) -> DataFrame:
    """Group by every bucket at once, then unpivot the far smaller result."""
    refs = [r.ref for r in group]
    combined = (
        group[0].source.frame.select(*[bucket(r).alias(r.ref) for r in group])
        .groupBy(*refs)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        combined.unpivot("n", refs, "ref", "col_val")
        .groupBy("ref", "col_val")
        .agg(F.sum("n").alias("col_val_cnt"))
    )


def sample_values(
    histogram: DataFrame, top: int = SAMPLE_VALUES, keys: Sequence[str] = COLUMN_KEY
) -> DataFrame:
    """``sample_data``: the most frequent values of each column, joined in order.

    Ties go to the smaller value. The rank limit is applied before the shuffle, so a
    column of any cardinality sends only ``top`` rows per task.
    """
    best_first = Window.partitionBy(*keys).orderBy(F.desc("col_val_cnt"), F.asc("col_val"))
    ranked = (
        histogram.filter(F.col("col_val") != NULL_MARK)
        .select(*keys, "col_val", "col_val_cnt", F.row_number().over(best_first).alias("rn"))
        .filter(F.col("rn") <= top)
    )
    in_order = F.array_sort(F.collect_list(F.struct("rn", "col_val")))
    return ranked.groupBy(*keys).agg(
        F.array_join(F.transform(in_order, lambda s: s["col_val"]), SAMPLE_SEPARATOR).alias(
            "sample_data"
        )
    )
