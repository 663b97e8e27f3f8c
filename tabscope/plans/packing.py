"""Packing tables into jobs by their size.

A table of at least ``job_mb`` has a job of its own; smaller ones share jobs, the larger
first, that close when the next table would start beyond ``job_mb`` or ``most_tables``.
So a job holds less than twice ``job_mb``, one huge table never waits for fifty others,
and thousands of tiny ones do not make thousands of jobs.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscope.operators.ranking import global_running

JOB_MB = 64 * 1024
TABLES_PER_JOB = 50

# The parallelism tiers of the table master, largest first.
TIERS = (16, 8, 4, 2)


def packed(
    tables: DataFrame, job_mb: int = JOB_MB, most_tables: int = TABLES_PER_JOB
) -> DataFrame:
    """``tables`` (owner_nm, tab_nm, tab_size) with ``job_no`` from 1, largest first.

    Unknown sizes count as 0. Positions and sums run over sorted partitions; only a row
    per partition, then a row per job, meets in one task.
    """
    sized = tables.withColumn("_mb", F.coalesce(F.col("tab_size"), F.lit(0)).cast("bigint"))
    big = F.col("_mb") >= job_mb
    small = sized.withColumns(
        {"_one": F.when(big, 0).otherwise(1).cast("bigint"), "_own": F.when(big, 0).otherwise(F.col("_mb"))}
    )
    order = [F.desc("_mb"), F.asc("owner_nm"), F.asc("tab_nm")]
    placed = global_running(small, order, "_nr", {"_one": "_smalls", "_own": "_before"})
    # Jobs of small tables: by the size and the number of small tables before each.
    slot = F.struct(
        F.when(big, F.col("_nr")).otherwise(F.lit(0)).alias("own"),
        F.when(big, F.lit(0)).otherwise(F.floor(F.col("_before") / job_mb) + 1).alias("by_size"),
        F.when(big, F.lit(0)).otherwise(F.floor(F.col("_smalls") / most_tables) + 1).alias("by_count"),
        F.when(big, F.lit(0)).otherwise(F.lit(1)).alias("shared"),
    )
    slotted = placed.withColumn("_slot", slot)
    jobs = slotted.groupBy("_slot").agg(F.min("_nr").alias("_first"))
    numbered = jobs.withColumn(
        "job_no", F.row_number().over(Window.orderBy("_first")).cast("int")
    )
    kept = [c for c in tables.columns]
    return slotted.join(numbered.drop("_first"), "_slot").select(*kept, "job_no")


def pool(tier: int | None) -> str:
    """The scheduler pool of a parallelism tier."""
    return f"tier-{tier}" if tier in TIERS else "default"


def allocation_file() -> str:
    """Fair-scheduler pools weighted by tier, for ``spark.scheduler.allocation.file``."""
    pools = "".join(
        f'  <pool name="{pool(t)}"><schedulingMode>FAIR</schedulingMode>'
        f"<weight>{t}</weight><minShare>0</minShare></pool>\n"
        for t in TIERS
    )
    return f'<?xml version="1.0"?>\n<allocations>\n{pools}</allocations>\n'


@contextmanager
def in_pool(spark: SparkSession, tier: int | None) -> Iterator[None]:
    """Jobs this thread starts inside run in the tier's pool."""
    context, key = spark.sparkContext, "spark.scheduler.pool"
    before = context.getLocalProperty(key)
    context.setLocalProperty(key, pool(tier))
    try:
        yield
    finally:
        context.setLocalProperty(key, before)
