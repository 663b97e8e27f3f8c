"""Frame shapes shared by the profile levels."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.plans.spec import ColumnRef

#: A frame is hinted for broadcast only if rows known from the plan times the widest
#: row stay under this; otherwise Spark chooses by measured size.
BROADCAST_BYTES = 32 * 1024 * 1024

#: Widest row of (ref, number), and of a full column key with a text of 100 characters.
NUMBER_ROW = 64
TEXT_ROW = 4096

#: Columns per unpivot: under the 100 fields whole-stage code generation accepts.
UNPIVOT_COLUMNS = 90


def shuffle_partitions(spark: SparkSession) -> int:
    """How many tasks a hot column is spread over."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def bounded_broadcast(df: DataFrame, rows: int, row_bytes: int = NUMBER_ROW) -> DataFrame:
    """Hint ``df`` for broadcast when its proven size is small enough."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def long_form(
    group: Sequence[ColumnRef],
    expr: Callable[[ColumnRef], Column],
    value_name: str,
    with_columns: Sequence[str] = (),
) -> DataFrame:
    """One row per (row, planned column): ``ref`` and the column's expression.

    ``with_columns`` of the table are repeated in every row.

    Spark plans the unpivot as an Expand over a pruned scan. Very wide tables are cut
    into runs of columns; the runs read disjoint columns.
    """
    if len(group) > UNPIVOT_COLUMNS:
        return union_all(
            long_form(group[i : i + UNPIVOT_COLUMNS], expr, value_name, with_columns)
            for i in range(0, len(group), UNPIVOT_COLUMNS)
        )
    kept = list(with_columns)
    wide = group[0].source.frame.select(*kept, *[expr(r).alias(r.ref) for r in group])
    if len(group) == 1:
        only = group[0].ref
        return wide.select(*kept, F.lit(only).alias("ref"), F.col(only).alias(value_name))
    return wide.unpivot(kept, [r.ref for r in group], "ref", value_name)


def source_column(ref: ColumnRef) -> Column:
    """The column of its own table, whatever characters its name holds."""
    return F.col("`" + ref.column.col_nm.replace("`", "``") + "`")
