"""Information-schema views shared by several vendors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.operators.dictionary.common import (
    CONSTRAINT_CODES,
    constraint_code,
    keep_schemas,
    shaped,
    text_or_empty,
    yes_no,
)


def table_columns(
    columns: DataFrame, views: DataFrame, schemas: Sequence[str]
) -> DataFrame:
    """Column rows of the listed schemas without those of views."""
    return keep_schemas(columns, "table_schema", schemas).join(
        views.select("table_schema", "table_name"), ["table_schema", "table_name"], "left_anti"
    )


def shaped_columns(df: DataFrame, comment: Column) -> DataFrame:
    """Length is the first known of character, numeric and datetime width."""
    return shaped(
        df,
        "columns",
        owner_nm=F.col("table_schema"),
        tab_nm=F.col("table_name"),
        col_nm=F.col("column_name"),
        col_comment=text_or_empty(comment),
        col_seq=F.col("ordinal_position"),
        data_type=F.col("data_type"),
        data_len=F.coalesce(
            "character_maximum_length", "numeric_precision", "datetime_precision"
        ),
        null_yn=yes_no(F.col("is_nullable") == "YES"),
        data_precision=F.col("numeric_precision"),
        data_scale=F.col("numeric_scale"),
        def_value=F.col("column_default"),
    )


def constraints(table_constraints: DataFrame, schemas: Sequence[str]) -> DataFrame:
    kept = keep_schemas(table_constraints, "table_schema", schemas).filter(
        F.col("constraint_type").isin(*CONSTRAINT_CODES)
    )
    return shaped(
        kept,
        "constraints",
        owner_nm=F.col("table_schema"),
        cons_nm=F.col("constraint_name"),
        cons_type=constraint_code(F.col("constraint_type")),
        table_nm=F.col("table_name"),
    )


def constraint_columns(
    key_column_usage: DataFrame, table_constraints: DataFrame, schemas: Sequence[str]
) -> DataFrame:
    """A constraint name is unique within its table only: MySQL calls every key PRIMARY."""
    key = ["table_schema", "table_name", "constraint_name"]
    members = keep_schemas(key_column_usage, "table_schema", schemas).select(
        *key, "column_name", "ordinal_position"
    )
    owners = table_constraints.filter(F.col("constraint_type").isin(*CONSTRAINT_CODES)).select(
        *key, "constraint_type"
    )
    return shaped(
        members.join(owners, key),
        "constraint_columns",
        owner_nm=F.col("table_schema"),
        cons_nm=F.col("constraint_name"),
        col_nm=F.col("column_name"),
        cons_type=constraint_code(F.col("constraint_type")),
        table_nm=F.col("table_name"),
        pos=F.col("ordinal_position"),
    )
