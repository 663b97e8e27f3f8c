"""Oracle catalog views to the common dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.dictionary.common import (
    GIB,
    INDEX_SEGMENTS,
    MIB,
    NO_PARTITION,
    TABLE_SEGMENTS,
    keep_schemas,
    not_recycled,
    shaped,
    text_or_empty,
    whole_units,
    yes_no,
)


def tables(
    all_tables: DataFrame,
    all_tab_comments: DataFrame,
    dba_segments: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    """Tables with comment and allocated size.

    Segments are summed per table before the join, so a table of many partitions
    meets the join as one row. Joins name the object before its owner: they sort by the
    first key, and owners are few.
    """
    base = keep_schemas(all_tables, "owner", schemas)
    comments = all_tab_comments.filter(F.col("table_type") == "TABLE").select(
        "owner", "table_name", "comments"
    )
    sizes = (
        keep_schemas(dba_segments, "owner", schemas)
        .filter(F.col("segment_type").isin(*TABLE_SEGMENTS))
        .groupBy(F.col("segment_name").alias("table_name"), "owner")
        .agg(F.sum("bytes").alias("bytes"))
    )
    joined = base.join(comments, ["table_name", "owner"], "left").join(
        sizes, ["table_name", "owner"], "left"
    )
    return shaped(
        joined,
        "tables",
        owner_nm=F.col("owner"),
        tab_nm=F.col("table_name"),
        tab_comment=text_or_empty(F.col("comments")),
        tablespace_nm=F.col("tablespace_name"),
        row_cnt=F.col("num_rows"),
        last_analyzed_dt=F.col("last_analyzed"),
        part_yn=yes_no(F.col("partitioned") == "YES"),
        tab_mb_size=whole_units(F.col("bytes"), MIB),
        tab_gb_size=whole_units(F.col("bytes"), GIB),
    )


def columns(
    all_tab_columns: DataFrame,
    all_col_comments: DataFrame,
    all_views: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    """Columns of tables; those of views are left out."""
    views = all_views.select("owner", F.col("view_name").alias("table_name"))
    comments = all_col_comments.select("owner", "table_name", "column_name", "comments")
    joined = (
        keep_schemas(all_tab_columns, "owner", schemas)
        .join(views, ["table_name", "owner"], "left_anti")
        .join(comments, ["table_name", "owner", "column_name"], "left")
    )
    return shaped(
        joined,
        "columns",
        owner_nm=F.col("owner"),
        tab_nm=F.col("table_name"),
        col_nm=F.col("column_name"),
        col_comment=text_or_empty(F.col("comments")),
        col_seq=F.col("column_id"),
        data_type=F.col("data_type"),
        data_len=F.col("data_length"),
        null_yn=F.col("nullable"),
        data_precision=F.col("data_precision"),
        data_scale=F.col("data_scale"),
        def_value=F.col("data_default"),
    )


def segments(dba_segments: DataFrame, schemas: Sequence[str]) -> DataFrame:
    kept = keep_schemas(dba_segments, "owner", schemas).filter(
        F.col("segment_type").isin(*TABLE_SEGMENTS, *INDEX_SEGMENTS)
        & not_recycled(F.col("segment_name"))
    )
    return shaped(
        kept,
        "segments",
        owner_nm=F.col("owner"),
        segment_nm=F.col("segment_name"),
        partition_nm=F.coalesce("partition_name", F.lit(NO_PARTITION)),
        segment_type=F.col("segment_type"),
        tablespace_nm=F.col("tablespace_name"),
        head_block_cnt=F.lit(0),
        segment_size=F.coalesce("bytes", F.lit(0)),
        block_cnt=F.lit(0),
    )


def _live_constraints(all_constraints: DataFrame) -> DataFrame:
    return all_constraints.filter(
        (F.col("status") == "ENABLED") & F.col("constraint_type").isin("P", "U", "R")
    )


def constraints(all_constraints: DataFrame, schemas: Sequence[str]) -> DataFrame:
    kept = keep_schemas(_live_constraints(all_constraints), "owner", schemas).filter(
        not_recycled(F.col("table_name"))
    )
    return shaped(
        kept,
        "constraints",
        owner_nm=F.col("owner"),
        cons_nm=F.col("constraint_name"),
        cons_type=F.col("constraint_type"),
        table_nm=F.col("table_name"),
    )


def constraint_columns(
    all_cons_columns: DataFrame, all_constraints: DataFrame, schemas: Sequence[str]
) -> DataFrame:
    members = keep_schemas(all_cons_columns, "owner", schemas).select(
        "owner", "constraint_name", "column_name", "position"
    )
    owners = _live_constraints(all_constraints).select(
        "owner", "constraint_name", "constraint_type", "table_name"
    )
    return shaped(
        members.join(owners, ["constraint_name", "owner"]),
        "constraint_columns",
        owner_nm=F.col("owner"),
        cons_nm=F.col("constraint_name"),
        col_nm=F.col("column_name"),
        cons_type=F.col("constraint_type"),
        table_nm=F.col("table_name"),
        pos=F.coalesce("position", F.lit(0)),
    )


def indexes(all_indexes: DataFrame, schemas: Sequence[str]) -> DataFrame:
    return shaped(
        keep_schemas(all_indexes, "owner", schemas),
        "indexes",
        owner_nm=F.col("owner"),
        index_nm=F.col("index_name"),
        tab_nm=F.col("table_name"),
        index_type=F.col("index_type"),
        uniqueness=F.col("uniqueness"),
        part_yn=yes_no(F.col("partitioned") == "YES"),
        status=F.col("status"),
        tablespace_nm=F.col("tablespace_name"),
    )


def index_owners(all_indexes: DataFrame) -> DataFrame:
    """Indexes with the schema of their table, which may differ from their own."""
    return all_indexes.select(
        F.col("owner").alias("owner_nm"),
        F.col("index_name").alias("index_nm"),
        F.col("table_owner").alias("tab_owner_nm"),
        F.col("table_name").alias("tab_nm"),
    )
