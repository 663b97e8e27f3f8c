"""Global row numbers and running sums without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.operators.shapes import bounded_broadcast
from tabscope.session import ensure_checkpoint_dir

_PARTITION_BITS = 33


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows 1..n in the given total order."""
    return global_running(df, order, name, {})


def global_running(
    df: DataFrame, order: Sequence[Column], name: str, sums: Mapping[str, str]
) -> DataFrame:
    """Number all rows 1..n in the given total order, and sum columns over the rows before.

    ``sums`` maps a number column to the name of its sum over all earlier rows.
    ``row_number() over (order by ...)`` would move every row into one task. Here the
    rows are range-sorted, tagged with partition and position, and checkpointed once so
    that the tags can not change on a retry; only the row count and the sums of each
    partition meet in one place. The tag is what ``monotonically_increasing_id`` defines:
    partition in the upper bits, position in the lower 33.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # A range sort reads its input twice, to sample and to sort: work it out once before.
    tagged = (
        df.checkpoint()
        .orderBy(*order)
        .withColumn("_tag", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_tag", _PARTITION_BITS).alias("_part")
    position = F.col("_tag") - F.shiftleft(F.col("_part"), _PARTITION_BITS)
    tagged = tagged.withColumn("_part", part)
    totals = {"_n": F.count(F.lit(1)), **{f"_sum{i}": F.sum(c) for i, c in enumerate(sums)}}
    sizes = tagged.groupBy("_part").agg(*[e.alias(n) for n, e in totals.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before{n}") for n in totals]
    )
    # One offset row per task of the sort.
    tasks = tagged.rdd.getNumPartitions()
    out = tagged.join(bounded_broadcast(offsets, tasks), "_part").withColumn(
        name, F.col("_before_n") + position + 1
    )
    inside = Window.partitionBy("_part").orderBy("_tag").rowsBetween(Window.unboundedPreceding, -1)
    for i, (column, total) in enumerate(sums.items()):
        own = F.coalesce(F.sum(column).over(inside), F.lit(0))
        out = out.withColumn(total, F.col(f"_before_sum{i}") + own)
    return out.drop("_tag", "_part", *[f"_before{n}" for n in totals])
