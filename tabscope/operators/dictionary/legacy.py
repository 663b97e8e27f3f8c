"""The older schema / table / column lists, under their own column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.dictionary.common import MIB

# Schemas the older lists leave out, and their table and column names.
LEGACY_EXCLUDED = ("SYS", "SYSCAT", "SYSGIS", "SYSTEM", "OUTLN")
LEGACY_TABLES = ("프로파일링_스키마정보", "프로파일링_테이블정보", "프로파일링_컬럼정보")
DB_NO = "DB번호"


def _db(db_no: int):
    return F.lit(db_no).cast("int").alias(DB_NO)


def schema_list(all_users: DataFrame, db_no: int) -> DataFrame:
    return all_users.filter(~F.col("username").isin(*LEGACY_EXCLUDED)).select(
        _db(db_no), F.col("username").alias("스키마명")
    )


def table_list(
    all_tables: DataFrame,
    all_tab_comments: DataFrame,
    dba_segments: DataFrame,
    dba_objects: DataFrame,
    db_no: int,
) -> DataFrame:
    """Tables that have a comment row; size in fractional MB over every segment type."""
    key = ["owner", "table_name"]
    sizes = dba_segments.groupBy("owner", F.col("segment_name").alias("table_name")).agg(
        F.sum("bytes").alias("bytes")
    )
    created = (
        dba_objects.filter(F.col("object_type").startswith("TABLE"))
        .groupBy("owner", F.col("object_name").alias("table_name"))
        .agg(F.min("created").alias("created"))
    )
    return (
        all_tables.filter(~F.col("owner").isin(*LEGACY_EXCLUDED))
        .select(*key)
        .join(all_tab_comments.select(*key, "comments"), key)
        .join(sizes, key, "left")
        .join(created, key, "left")
        .select(
            _db(db_no),
            F.col("owner").alias("스키마명"),
            F.col("table_name").alias("테이블명"),
            F.coalesce("comments", F.lit("")).alias("테이블코멘트"),
            (F.coalesce("bytes", F.lit(0)) / F.lit(MIB)).cast("double").alias("테이블사이즈"),
            F.col("created").alias("테이블최초생성일시"),
        )
    )


def column_list(
    all_tab_columns: DataFrame,
    all_col_comments: DataFrame,
    all_constraints: DataFrame,
    all_cons_columns: DataFrame,
    all_views: DataFrame,
    db_no: int,
) -> DataFrame:
    """Columns that have a comment row; a positive precision stands in for the length."""
    key = ["owner", "table_name", "column_name"]
    primary = all_constraints.filter(F.col("constraint_type") == "P").select(
        "owner", "table_name", "constraint_name"
    )
    members = (
        all_cons_columns.select(*key, "constraint_name")
        .join(primary, ["owner", "table_name", "constraint_name"])
        .select(*key, F.lit("Y").alias("pk"))
    )
    return (
        all_tab_columns.filter(~F.col("owner").isin(*LEGACY_EXCLUDED))
        .join(
            all_views.select("owner", F.col("view_name").alias("table_name")),
            ["owner", "table_name"],
            "left_anti",
        )
        .join(all_col_comments.select(*key, "comments"), key)
        .join(members, key, "left")
        .select(
            _db(db_no),
            F.col("owner").alias("스키마명"),
            F.col("table_name").alias("테이블명"),
            F.col("column_name").alias("컬럼명"),
            F.coalesce("comments", F.lit("")).alias("컬럼코멘트"),
            F.col("data_type").alias("데이터타입"),
            F.col("column_id").cast("int").alias("컬럼순서"),
            F.col("nullable").alias("NULL여부"),
            F.coalesce("pk", F.lit("")).alias("PK여부"),
            F.when(F.col("data_precision") > 0, F.col("data_precision"))
            .otherwise(F.col("data_length"))
            .cast("int")
            .alias("길이"),
            F.coalesce("data_scale", F.lit(0)).cast("int").alias("소수점"),
        )
    )


def repository_columns(columns: DataFrame) -> DataFrame:
    """Column list as it is stored: a scale of zero is stored as NULL."""
    return columns.withColumn("소수점", F.nullif("소수점", F.lit(0)))


def rows_exist(schemas: DataFrame, tables: DataFrame, columns: DataFrame, db_no: int) -> DataFrame:
    """``cnt``: how many of the three lists hold any row of the database (0 to 3)."""

    def any_row(df: DataFrame) -> DataFrame:
        return df.filter(F.col(DB_NO) == db_no).limit(1).agg(F.count(F.lit(1)).alias("cnt"))

    probes = any_row(schemas).unionByName(any_row(tables)).unionByName(any_row(columns))
    return probes.agg(F.sum("cnt").alias("cnt"))
