"""The whole profile of some tables as one frame: a row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabscope.operators.column_stats import column_stats
from tabscope.operators.pattern_dist import (
    numbered_pattern_counts,
    pattern_counts_from_values,
    top_pattern,
)
from tabscope.operators.shapes import TEXT_ROW, bounded_broadcast
from tabscope.operators.value_dist import numbered_histogram, sample_values
from tabscope.plans.spec import COLUMN_KEY, ProfileInput, name_columns


def profile_report(
    inputs: Sequence[ProfileInput],
    *,
    levels: Sequence[str] = ("value", "pattern"),
    pattern_source: str = "values",
    pattern_mode: str = "executed",
    value_chars: int | None = None,
    extreme_chars: int | None = None,
) -> DataFrame:
    """Row count, column statistics, samples and top pattern of every column.

    The statistics always run; ``levels`` adds the value and the pattern level.
    Everything joined here has at most one row per planned column; it is broadcast
    unless whole texts (``value_chars=None``) leave its width unbounded.
    """
    n_columns = sum(len(source.stat_columns()) for source in inputs)

    def attach(report: DataFrame, facts: DataFrame) -> DataFrame:
        if value_chars is not None:
            facts = bounded_broadcast(facts, n_columns, TEXT_ROW)
        return report.join(facts, list(COLUMN_KEY), "left")

    report = column_stats(inputs, with_row_count=True, extreme_chars=extreme_chars)
    histogram, groups = None, []
    if any(source.value_columns() for source in inputs):
        histogram, groups = numbered_histogram(inputs, value_chars=value_chars)
    if "value" in levels and histogram is not None:
        report = attach(report, name_columns(sample_values(histogram, keys=["ref"]), groups))
    if "pattern" in levels:
        counts = None
        if pattern_source == "direct" and any(source.pattern_columns() for source in inputs):
            counts, groups = numbered_pattern_counts(
                inputs, pattern_mode, value_chars=value_chars
            )
        elif pattern_source == "values" and histogram is not None:
            counts = pattern_counts_from_values(histogram, pattern_mode, ["ref"])
        if counts is not None:
            report = attach(report, name_columns(top_pattern(counts, ["ref"]), groups))
    return report
