"""Table level: row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.shapes import union_all
from tabscope.plans.spec import ProfileInput


def row_counts(inputs: Sequence[ProfileInput]) -> DataFrame:
    """``tab_cnt`` of every table, as one job. No column is read to count rows."""

    def one(source: ProfileInput) -> DataFrame:
        s = source.spec
        return source.frame.agg(F.count(F.lit(1)).alias("tab_cnt")).select(
            F.lit(s.db_nm).alias("db_nm"),
            F.lit(s.owner_nm).alias("owner_nm"),
            F.lit(s.tab_nm).alias("tab_nm"),
            F.lit(s.prfl_id).alias("prfl_id"),
            "tab_cnt",
        )

    return union_all(one(source) for source in inputs)
