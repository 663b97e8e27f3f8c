"""Profile levels of tables whose source does the grouping, and of mixed jobs.

A relational source counts, aggregates and groups its own tables; what crosses the
connection is a row per table, a row of aggregates, or a histogram. The frames have the
columns of those made from files, so both meet in one job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.operators.column_stats import column_stats
from tabscope.operators.shapes import union_all
from tabscope.operators.table_stats import row_counts
from tabscope.operators.value_dist import value_histogram
from tabscope.plans.spec import ColumnSpec, ProfileInput, TableSpec
from tabscope.sources import statements


@dataclass(frozen=True)
class RemoteTable:
    """A table of a source that runs SELECTs. ``rows`` reads the table itself."""

    vendor: str
    name: tuple[str, ...]
    run: Callable[[str], DataFrame]
    rows: Callable[[], DataFrame]


class RemoteInput(ProfileInput):
    """A table to profile in its source. Types come from the plan, not from a reader.

    Where rows are needed after all (direct patterns), ``frame`` reads them.
    """

    def __init__(self, spec: TableSpec, source: RemoteTable):
        object.__setattr__(self, "spec", spec)
        object.__setattr__(self, "source", source)

    def __repr__(self) -> str:
        return f"RemoteInput({self.spec!r}, {self.source.name!r})"

    @cached_property
    def frame(self) -> DataFrame:
        return self.source.rows()

    def missing_columns(self) -> list[str]:
        """The source reports a column it no longer has."""
        return []

    def _structured(self) -> list[ColumnSpec]:
        return [c for c in self.spec.columns if c.use and statements.is_structured(c)]


def _named(source: ProfileInput, frame: DataFrame, *columns: Column | str) -> DataFrame:
    s = source.spec
    keys = {"db_nm": s.db_nm, "owner_nm": s.owner_nm, "tab_nm": s.tab_nm}
    return frame.select(*[F.lit(v).alias(k) for k, v in keys.items()], *columns)


def _remote_count(source: RemoteInput) -> DataFrame:
    t = source.source
    found = t.run(statements.count_statement(t.vendor, t.name))
    count = F.col("tab_cnt").cast("bigint").alias("tab_cnt")
    return _named(source, found, F.lit(source.spec.prfl_id).alias("prfl_id"), count)


def _batches(columns: Sequence[ColumnSpec], size: int) -> list[Sequence[ColumnSpec]]:
    return [columns[i : i + size] for i in range(0, len(columns), size)]


def _remote_stats(source: RemoteInput, chars: int | None, batch_columns: int) -> DataFrame:
    t = source.source

    def extreme(name: str) -> Column:
        text = F.col(name).cast("string")
        return text if chars is None else F.substring(text, 1, chars)

    def one(batch: Sequence[ColumnSpec]) -> DataFrame:
        found = t.run(statements.stats_statement(t.vendor, t.name, batch))
        rows = [
            F.struct(
                F.lit(c.col_nm).alias("col_nm"),
                F.col(f"n{i}").cast("bigint").alias("notnull_cnt"),
                F.col(f"k{i}").cast("bigint").alias("col_kind"),
                extreme(f"h{i}").alias("max_col_val"),
                extreme(f"l{i}").alias("min_col_val"),
                F.coalesce(F.col(f"m{i}").cast("int"), F.lit(0)).alias("max_len"),
            )
            for i, c in enumerate(batch)
        ]
        return found.select(F.inline(F.array(*rows)))

    found = union_all(one(b) for b in _batches(source.stat_columns(), batch_columns))
    stats = ["notnull_cnt", "col_kind", "max_col_val", "min_col_val", "max_len"]
    return _named(source, found, "col_nm", F.lit(source.spec.prfl_id).alias("prfl_id"), *stats)


def _remote_histogram(source: RemoteInput, batch_columns: int, **options) -> DataFrame:
    t = source.source

    def one(batch: Sequence[ColumnSpec]) -> DataFrame:
        found = t.run(statements.histogram_statement(t.vendor, t.name, batch, **options))
        names = F.array(*[F.lit(c.col_nm) for c in batch])
        return found.select(
            F.element_at(names, F.col("col_no").cast("int") + 1).alias("col_nm"),
            F.col("col_val").cast(T.StringType()).alias("col_val"),
            F.col("col_val_cnt").cast("bigint").alias("col_val_cnt"),
        )

    found = union_all(one(b) for b in _batches(source.value_columns(), batch_columns))
    profile = F.lit(source.spec.prfl_id).alias("prfl_id")
    return _named(source, found, "col_nm", profile, "col_val", "col_val_cnt")


def _both(
    inputs: Sequence[ProfileInput],
    local: Callable[[list[ProfileInput]], DataFrame],
    remote: Callable[[RemoteInput], DataFrame],
) -> DataFrame:
    here = [s for s in inputs if not isinstance(s, RemoteInput)]
    there = [s for s in inputs if isinstance(s, RemoteInput)]
    return union_all([*([local(here)] if here else []), *map(remote, there)])


def counts(inputs: Sequence[ProfileInput]) -> DataFrame:
    """``tab_cnt`` of every table, counted where it lives."""
    return _both(inputs, row_counts, _remote_count)


def stats(
    inputs: Sequence[ProfileInput],
    extreme_chars: int | None = None,
    batch_columns: int = statements.BATCH_COLUMNS,
) -> DataFrame:
    """Column statistics; see :func:`column_stats`."""
    return _both(
        inputs,
        lambda here: column_stats(here, extreme_chars=extreme_chars),
        lambda source: _remote_stats(source, extreme_chars, batch_columns),
    )


def histogram(
    inputs: Sequence[ProfileInput],
    *,
    strategy: str = "unpivot",
    batch_columns: int = statements.BATCH_COLUMNS,
    **options,
) -> DataFrame:
    """Value histograms; see :func:`value_histogram`. A strategy is for files only."""
    return _both(
        inputs,
        lambda here: value_histogram(here, strategy=strategy, **options),
        lambda source: _remote_histogram(source, batch_columns, **options),
    )
