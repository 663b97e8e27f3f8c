"""SQL Server catalog views to the common dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.dictionary.common import (
    KIB,
    NO_PARTITION,
    schema_names,
    shaped,
    text_or_empty,
    yes_no,
)

# Name of the comment property and size of a page.
COMMENT_PROPERTY = "MS_Description"
PAGE_KIB = 8


def _user_tables(sys_tables: DataFrame, sys_schemas: DataFrame, schemas: Sequence[str]) -> DataFrame:
    named = schema_names(
        sys_schemas.select("schema_id", F.col("name").alias("schema_name")), "schema_name", schemas
    )
    return sys_tables.select("object_id", "schema_id", F.col("name").alias("table_name")).join(
        named, "schema_id"
    )


def _comments(extended_properties: DataFrame) -> DataFrame:
    return extended_properties.filter(F.col("name") == COMMENT_PROPERTY).select(
        F.col("major_id").alias("object_id"), "minor_id", F.col("value").alias("comment")
    )


def tables(
    sys_tables: DataFrame,
    sys_schemas: DataFrame,
    extended_properties: DataFrame,
    partitions: DataFrame,
    allocation_units: DataFrame,
    schemas: Sequence[str],
    rows_per_unit: bool = True,
) -> DataFrame:
    """Tables with row count and pages.

    By default a partition's rows count once per allocation unit, as in the profile
    tables this reproduces; ``rows_per_unit=False`` counts them once. Units are summed
    per partition, and partitions per table, before anything is joined to them.
    """
    comments = (
        _comments(extended_properties).filter(F.col("minor_id") == 0).drop("minor_id")
    )
    units = allocation_units.groupBy(F.col("container_id").alias("partition_id")).agg(
        F.sum("total_pages").alias("pages"), F.count(F.lit(1)).alias("units")
    )
    times = F.coalesce("units", F.lit(1)) if rows_per_unit else F.lit(1)
    sizes = (
        partitions.filter(F.col("index_id") <= 1)
        .select("object_id", "partition_id", "rows")
        .join(units, "partition_id", "left")
        .groupBy("object_id")
        .agg(F.sum(F.col("rows") * times).alias("row_cnt"), F.sum("pages").alias("pages"))
    )
    joined = (
        _user_tables(sys_tables, sys_schemas, schemas)
        .join(comments, "object_id", "left")
        .join(sizes, "object_id", "left")
    )
    kib = F.col("pages").cast("decimal(20,0)") * PAGE_KIB
    return shaped(
        joined,
        "tables",
        owner_nm=F.col("schema_name"),
        tab_nm=F.col("table_name"),
        tab_comment=text_or_empty(F.col("comment")),
        row_cnt=F.col("row_cnt"),
        part_yn=F.lit("N"),
        tab_mb_size=F.round(kib / KIB, 2),
        tab_gb_size=F.round(kib / (KIB * KIB), 4),
    )


def columns(
    sys_columns: DataFrame,
    sys_tables: DataFrame,
    sys_schemas: DataFrame,
    sys_types: DataFrame,
    extended_properties: DataFrame,
    default_constraints: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    types = sys_types.select("user_type_id", F.col("name").alias("type_name"))
    comments = _comments(extended_properties).withColumnRenamed("minor_id", "column_id")
    defaults = default_constraints.select(
        F.col("parent_object_id").alias("object_id"),
        F.col("parent_column_id").alias("column_id"),
        "definition",
    )
    joined = (
        sys_columns.withColumnRenamed("name", "column_name")
        .join(_user_tables(sys_tables, sys_schemas, schemas), "object_id")
        .join(types, "user_type_id")
        .join(comments, ["object_id", "column_id"], "left")
        .join(defaults, ["object_id", "column_id"], "left")
    )
    return shaped(
        joined,
        "columns",
        owner_nm=F.col("schema_name"),
        tab_nm=F.col("table_name"),
        col_nm=F.col("column_name"),
        col_comment=text_or_empty(F.col("comment")),
        col_seq=F.col("column_id"),
        data_type=F.col("type_name"),
        data_len=F.coalesce("max_length", "precision"),
        null_yn=yes_no(F.col("is_nullable") == 1),
        data_precision=F.col("precision"),
        data_scale=F.col("scale"),
        def_value=F.col("definition"),
    )


def segments(
    sys_tables: DataFrame,
    sys_schemas: DataFrame,
    partitions: DataFrame,
    allocation_units: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    """One table segment per table: the pages of its data and its indexes.

    A partition has three allocation units at most: only the sum per table is worth making.
    """
    units = allocation_units.select(F.col("container_id").alias("partition_id"), "total_pages")
    sizes = (
        partitions.select("object_id", "partition_id")
        .join(units, "partition_id")
        .groupBy("object_id")
        .agg((F.sum("total_pages") * PAGE_KIB * KIB).alias("bytes"))
    )
    return shaped(
        _user_tables(sys_tables, sys_schemas, schemas).join(sizes, "object_id", "left"),
        "segments",
        owner_nm=F.col("schema_name"),
        segment_nm=F.col("table_name"),
        partition_nm=F.lit(NO_PARTITION),
        segment_type=F.lit("TABLE"),
        head_block_cnt=F.lit(0),
        segment_size=F.coalesce("bytes", F.lit(0)),
        block_cnt=F.lit(0),
    )


def indexes(
    sys_indexes: DataFrame, sys_tables: DataFrame, sys_schemas: DataFrame, schemas: Sequence[str]
) -> DataFrame:
    named = sys_indexes.filter(F.col("name").isNotNull()).withColumnRenamed("name", "index_name")
    return shaped(
        named.join(_user_tables(sys_tables, sys_schemas, schemas), "object_id"),
        "indexes",
        owner_nm=F.col("schema_name"),
        index_nm=F.col("index_name"),
        tab_nm=F.col("table_name"),
        index_type=F.col("type_desc"),
        uniqueness=F.when(F.col("is_unique") == 1, "UNIQUE").otherwise("NONUNIQUE"),
        part_yn=F.lit("N"),
        status=F.when(F.col("is_disabled") == 0, "VALID").otherwise("UNUSABLE"),
    )
