"""Pattern level: histograms of character-class patterns, shares, top pattern."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.buckets import NULL_MARK, leading
from tabscope.functions.patterns import char_pattern
from tabscope.functions.text import canonical_text
from tabscope.operators.shapes import (
    BROADCAST_BYTES,
    NUMBER_ROW,
    TEXT_ROW,
    long_form,
    shuffle_partitions,
    source_column,
    union_all,
)
from tabscope.plans.spec import COLUMN_KEY, ColumnRef, ProfileInput, name_columns, number_columns

def share_text(count: Column, total: Column) -> Column:
    """Percentage with two places, rounded half up, as text; NULL for a zero total.

    Integer arithmetic on hundredths keeps it exact at any count.
    """
    hundredths = F.call_function("div", count * 20000 + total, total * 2)
    hundredths = F.when(total > 0, hundredths)
    return (hundredths.cast(T.DecimalType(9, 0)) / 100).cast(T.DecimalType(9, 2)).cast("string")


def with_share(
    counts: DataFrame,
    keys: Sequence[str] = COLUMN_KEY,
    columns: int | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Add ``col_pat_rt``, the share of each pattern within its column.

    The totals are one row per column (``keys``, ``total``). A window over the column
    would put a whole histogram into one task, so they are joined: broadcast when
    ``columns`` proves them small, else on the key and a salt, one per shuffle partition.
    """
    if totals is None:
        totals = counts.groupBy(*keys).agg(F.sum("col_pat_cnt").alias("total"))
    row_bytes = NUMBER_ROW if len(keys) == 1 else TEXT_ROW
    if columns is not None and columns * row_bytes <= BROADCAST_BYTES:
        joined = counts.join(F.broadcast(totals), list(keys))
    else:
        # A salt that could be NULL would make the join filter the tables by it, that is,
        # work out every pattern once more before anything is counted.
        salts = shuffle_partitions(counts.sparkSession)
        salt = F.pmod(F.xxhash64("col_pat"), F.lit(salts)).cast("int")
        salt = F.coalesce(salt, F.lit(0))
        spread = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = counts.withColumn("salt", salt).join(spread, [*keys, "salt"]).drop("salt")
    return joined.withColumn(
        "col_pat_rt", share_text(F.col("col_pat_cnt"), F.col("total"))
    ).drop("total")


def pattern_counts_from_values(
    value_histogram: DataFrame, mode: str = "executed", keys: Sequence[str] = COLUMN_KEY
) -> DataFrame:
    """Pattern counts of an existing value histogram; the tables are not read."""
    return (
        value_histogram.filter(F.col("col_val") != NULL_MARK)
        .select(*keys, char_pattern(F.col("col_val"), mode).alias("col_pat"), "col_val_cnt")
        .groupBy(*keys, "col_pat")
        .agg(F.sum("col_val_cnt").alias("col_pat_cnt"))
    )


def patterns_from_values(
    value_histogram: DataFrame,
    mode: str = "executed",
    columns: int | None = None,
    keys: Sequence[str] = COLUMN_KEY,
) -> DataFrame:
    """Pattern counts and shares of an existing value histogram.

    The totals come from the values, so that no pattern is worked out twice.
    """
    totals = (
        value_histogram.filter(F.col("col_val") != NULL_MARK)
        .groupBy(*keys)
        .agg(F.sum("col_val_cnt").alias("total"))
    )
    counts = pattern_counts_from_values(value_histogram, mode, keys)
    return with_share(counts, keys, columns, totals)


def _direct(
    inputs: Sequence[ProfileInput], mode: str, value_chars: int | None, two_phase: bool
) -> tuple[DataFrame, list[list[ColumnRef]]]:
    groups = number_columns((source, source.pattern_columns()) for source in inputs)
    if not groups:
        raise ValueError("no column is flagged for patterns")

    def text_of(r: ColumnRef) -> Column:
        text = canonical_text(source_column(r), r.source.dtype(r.column.col_nm), r.column.decimals)
        return leading(text, value_chars)

    texts = union_all(long_form(group, text_of, "raw") for group in groups).filter(
        F.col("raw").isNotNull()
    )
    pattern = char_pattern(F.col("raw"), mode).alias("col_pat")
    if two_phase:
        values = texts.groupBy("ref", "raw").agg(F.count(F.lit(1)).alias("n"))
        counts = values.groupBy("ref", pattern).agg(F.sum("n").alias("col_pat_cnt"))
    else:
        counts = texts.groupBy("ref", pattern).agg(F.count(F.lit(1)).alias("col_pat_cnt"))
    return counts, groups


def numbered_pattern_counts(
    inputs: Sequence[ProfileInput],
    mode: str = "executed",
    *,
    value_chars: int | None = None,
    two_phase: bool = False,
) -> tuple[DataFrame, list[list[ColumnRef]]]:
    """Pattern counts straight from the tables, on the short key ``ref``."""
    return _direct(inputs, mode, value_chars, two_phase)


def pattern_counts_direct(
    inputs: Sequence[ProfileInput],
    mode: str = "executed",
    *,
    value_chars: int | None = None,
    two_phase: bool = False,
) -> DataFrame:
    """Pattern counts straight from the tables: one scan per table, NULLs left out.

    ``two_phase`` counts raw values first and converts each distinct value once; worth
    it when values repeat a lot. Whole texts are converted unless ``value_chars`` cuts them.
    """
    return name_columns(*_direct(inputs, mode, value_chars, two_phase))


def patterns_direct(
    inputs: Sequence[ProfileInput],
    mode: str = "executed",
    *,
    value_chars: int | None = None,
    two_phase: bool = False,
) -> DataFrame:
    """Pattern counts and shares straight from the tables; see the counts for options."""
    counts, groups = _direct(inputs, mode, value_chars, two_phase)
    return name_columns(with_share(counts, ["ref"], sum(map(len, groups))), groups)


def top_pattern(pattern_histogram: DataFrame, keys: Sequence[str] = COLUMN_KEY) -> DataFrame:
    """``top_col_pat``: the most frequent pattern per column, ties to the smaller."""
    best_first = Window.partitionBy(*keys).orderBy(F.desc("col_pat_cnt"), F.asc("col_pat"))
    return (
        pattern_histogram.select(
            *keys, F.col("col_pat").alias("top_col_pat"), "col_pat_cnt",
            F.row_number().over(best_first).alias("rn"),
        )
        .filter(F.col("rn") == 1)
        .select(*keys, "top_col_pat")
    )
