"""MySQL / MariaDB information schema to the common dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.operators.dictionary.ansi import shaped_columns, table_columns
from tabscope.operators.dictionary.common import (
    GIB,
    MIB,
    NO_PARTITION,
    keep_schemas,
    shaped,
    text_or_empty,
)


def _bytes() -> Column:
    return F.coalesce(F.col("data_length") + F.col("index_length"), F.lit(0))


def _units(unit: int, places: int) -> Column:
    return F.round(_bytes().cast("decimal(20,0)") / F.lit(unit), places)


def tables(info_tables: DataFrame, schemas: Sequence[str]) -> DataFrame:
    kept = keep_schemas(info_tables, "table_schema", schemas).filter(
        F.col("table_type") == "BASE TABLE"
    )
    return shaped(
        kept,
        "tables",
        owner_nm=F.col("table_schema"),
        tab_nm=F.col("table_name"),
        tab_comment=text_or_empty(F.col("table_comment")),
        row_cnt=F.col("table_rows"),
        last_analyzed_dt=F.col("update_time"),
        part_yn=F.lit("N"),
        tab_mb_size=_units(MIB, 2),
        tab_gb_size=_units(GIB, 4),
    )


def columns(
    info_columns: DataFrame, info_views: DataFrame, schemas: Sequence[str]
) -> DataFrame:
    return shaped_columns(
        table_columns(info_columns, info_views, schemas), F.col("column_comment")
    )


def segments(info_tables: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """One table segment per table or view, data and indexes together."""
    return shaped(
        keep_schemas(info_tables, "table_schema", schemas),
        "segments",
        owner_nm=F.col("table_schema"),
        segment_nm=F.col("table_name"),
        partition_nm=F.lit(NO_PARTITION),
        segment_type=F.lit("TABLE"),
        head_block_cnt=F.lit(0),
        segment_size=_bytes(),
        block_cnt=F.lit(0),
    )


def indexes(statistics: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """The extract has a row per index column; the result one per index."""
    one_each = (
        keep_schemas(statistics, "table_schema", schemas)
        .select("table_schema", "index_name", "table_name", "index_type", "non_unique")
        .distinct()
    )
    return shaped(
        one_each,
        "indexes",
        owner_nm=F.col("table_schema"),
        index_nm=F.col("index_name"),
        tab_nm=F.col("table_name"),
        index_type=F.col("index_type"),
        uniqueness=F.when(F.col("non_unique") == 0, "UNIQUE").otherwise("NONUNIQUE"),
        part_yn=F.lit("N"),
        status=F.lit("VALID"),
    )
