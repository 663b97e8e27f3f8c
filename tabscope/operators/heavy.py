"""Most frequent values and patterns without a full histogram.

A first pass counts hash buckets of the values: a summary of bounded size a column,
whatever the column holds. No value occurs more often than its bucket is full. A second
pass counts the values of each column's fullest buckets exactly. If the last value wanted
is more frequent than any bucket that was left out is full, the answer is proven; columns
for which it is not (many values of about the same frequency) fall back to the histogram.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.buckets import NULL_MARK, leading
from tabscope.functions.patterns import char_pattern
from tabscope.functions.text import canonical_text
from tabscope.operators.pattern_dist import top_pattern
from tabscope.operators.shapes import bounded_broadcast, long_form, source_column, union_all
from tabscope.operators.value_dist import SAMPLE_VALUES, bucket_rows, sample_values
from tabscope.plans.spec import ColumnRef, ProfileInput, name_columns, number_columns
from tabscope.session import ensure_checkpoint_dir

#: Buckets a column is summed in, and those whose values are counted exactly.
BUCKETS = 1 << 14
EXACT_BUCKETS = 64

Groups = Sequence[Sequence[ColumnRef]]


def heaviest(
    rows: DataFrame,
    n_columns: int,
    top: int,
    buckets: int = BUCKETS,
    exact_buckets: int = EXACT_BUCKETS,
) -> tuple[DataFrame, list[str]]:
    """The ``top`` most frequent of ``rows(ref, value)``, and the refs they are proven for.

    Returns (``ref``, ``value``, ``n``); ties go to the smaller value. The second pass
    reads ``rows`` again. A row a proven column reaches the driver.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    fullest = Window.partitionBy("ref").orderBy(F.desc("n"), "bucket")
    summary = (
        placed.groupBy("ref", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.row_number().over(fullest))
        .where(F.col("rank") <= exact_buckets + 1)
        .checkpoint()
    )
    kept = summary.where(F.col("rank") <= exact_buckets).select("ref", "bucket")
    left_out = summary.where(F.col("rank") > exact_buckets).select("ref", F.col("n").alias("most"))
    best = Window.partitionBy("ref").orderBy(F.desc("n"), "value")
    counted = (
        placed.join(bounded_broadcast(kept, n_columns * exact_buckets), ["ref", "bucket"])
        .groupBy("ref", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= top)
        .join(bounded_broadcast(left_out, n_columns), "ref", "left")
        .checkpoint()
    )
    proven = F.col("most").isNull() | ((F.count(F.lit(1)) == top) & (F.min("n") > F.col("most")))
    refs = counted.groupBy("ref", "most").agg(proven.alias("proven")).where("proven")
    return counted.select("ref", "value", "n"), [r.ref for r in refs.select("ref").collect()]


def _mostly(
    groups: Groups,
    rows_of: Callable[[Groups], DataFrame],
    top: int,
    finish: Callable[[DataFrame], DataFrame],
    **limits: int,
) -> DataFrame:
    """``finish`` of (ref, value, n): of the heaviest where proven, else of the histogram."""
    n_columns = sum(map(len, groups))
    found, refs = heaviest(rows_of(groups), n_columns, top, **limits)
    proven = set(refs)
    open_ = [g for group in groups if (g := [r for r in group if r.ref not in proven])]
    counts = found.where(F.col("ref").isin(refs))
    if open_:
        histogram = rows_of(open_).groupBy("ref", "value").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.unionByName(histogram)
    return name_columns(finish(counts), groups)


def sample_values_bounded(
    inputs: Sequence[ProfileInput], top: int = SAMPLE_VALUES, limits: dict[str, int] | None = None, **options
) -> DataFrame:
    """``sample_data`` as :func:`sample_values` of the histograms gives it."""
    groups = number_columns((source, source.value_columns()) for source in inputs)

    def rows_of(some: Groups) -> DataFrame:
        rows = bucket_rows(some, **options).withColumnRenamed("col_val", "value")
        return rows.where(F.col("value") != NULL_MARK)

    def finish(counts: DataFrame) -> DataFrame:
        named = counts.withColumnsRenamed({"value": "col_val", "n": "col_val_cnt"})
        return sample_values(named, top, keys=["ref"])

    return _mostly(groups, rows_of, top, finish, **(limits or {}))


def top_pattern_bounded(
    inputs: Sequence[ProfileInput],
    mode: str = "executed",
    value_chars: int | None = None,
    limits: dict[str, int] | None = None,
) -> DataFrame:
    """``top_col_pat`` as :func:`top_pattern` of the direct pattern counts gives it."""
    groups = number_columns((source, source.pattern_columns()) for source in inputs)

    def text_of(r: ColumnRef) -> Column:
        text = canonical_text(source_column(r), r.source.dtype(r.column.col_nm), r.column.decimals)
        return char_pattern(leading(text, value_chars), mode)

    def rows_of(some: Groups) -> DataFrame:
        rows = union_all(long_form(group, text_of, "value") for group in some)
        return rows.where(F.col("value").isNotNull())

    def finish(counts: DataFrame) -> DataFrame:
        named = counts.withColumnsRenamed({"value": "col_pat", "n": "col_pat_cnt"})
        return top_pattern(named, keys=["ref"])

    return _mostly(groups, rows_of, 1, finish, **(limits or {}))
