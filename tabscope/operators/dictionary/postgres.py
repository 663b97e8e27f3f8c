"""PostgreSQL catalog to the common dictionary.

Functions the catalog offers only inside the server (object size, object comment)
are columns of the extract: ``total_bytes`` and ``size_bytes`` of pg_class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.dictionary.ansi import shaped_columns, table_columns
from tabscope.operators.dictionary.common import (
    GIB,
    MIB,
    NO_PARTITION,
    keep_schemas,
    schema_names,
    shaped,
    text_or_empty,
    whole_units,
)

# Relation kinds and the segment type they stand for.
RELATION_KINDS = {
    "r": "TABLE",
    "p": "TABLE PARTITION",
    "i": "INDEX",
    "I": "INDEX PARTITION",
}


def _relations(pg_class: DataFrame, pg_namespace: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """Relations of the listed schemas."""
    namespaces = pg_namespace.select(
        F.col("oid").alias("relnamespace"), F.col("nspname").alias("table_schema")
    )
    return pg_class.join(schema_names(namespaces, "table_schema", schemas), "relnamespace")


def _relation_comments(pg_description: DataFrame) -> DataFrame:
    """Comments on relations; an oid is unique within its system catalog only."""
    return pg_description.filter(F.col("classname") == "pg_class")


def tables(
    info_tables: DataFrame,
    pg_class: DataFrame,
    pg_namespace: DataFrame,
    pg_tablespace: DataFrame,
    pg_stat: DataFrame,
    pg_description: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    key = ["table_schema", "table_name"]
    base = keep_schemas(info_tables, "table_schema", schemas).filter(
        F.col("table_type") == "BASE TABLE"
    )
    # Most relations are indexes, sequences and the like: those no table is named like go first.
    relations = (
        _relations(pg_class, pg_namespace, schemas)
        .select(
            "table_schema", F.col("relname").alias("table_name"), "oid", "reltablespace",
            "total_bytes",
        )
        .join(base.select(*key), key, "left_semi")
    )
    spaces = pg_tablespace.select(F.col("oid").alias("reltablespace"), "spcname")
    stats = pg_stat.select(
        F.col("schemaname").alias("table_schema"),
        F.col("relname").alias("table_name"),
        "n_live_tup",
        "last_analyze",
    )
    comments = _relation_comments(pg_description).filter(F.col("objsubid") == 0).select(
        F.col("objoid").alias("oid"), "description"
    )
    # Facts hang on the relation, whose ids are never NULL; tables meet them by name.
    described = relations.join(spaces, "reltablespace", "left").join(comments, "oid", "left")
    joined = base.join(described, key, "left").join(stats, key, "left")
    return shaped(
        joined,
        "tables",
        owner_nm=F.col("table_schema"),
        tab_nm=F.col("table_name"),
        tab_comment=text_or_empty(F.col("description")),
        tablespace_nm=F.col("spcname"),
        row_cnt=F.col("n_live_tup"),
        last_analyzed_dt=F.col("last_analyze"),
        part_yn=F.lit("N"),
        tab_mb_size=whole_units(F.col("total_bytes"), MIB),
        tab_gb_size=whole_units(F.col("total_bytes"), GIB),
    )


def columns(
    info_columns: DataFrame,
    info_views: DataFrame,
    pg_stat: DataFrame,
    pg_description: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    """Comments hang on the relation id, which the statistics view supplies."""
    relations = pg_stat.select(
        F.col("schemaname").alias("table_schema"),
        F.col("relname").alias("table_name"),
        F.col("relid").alias("objoid"),
    )
    comments = _relation_comments(pg_description).select(
        "objoid", F.col("objsubid").alias("ordinal_position"), "description"
    )
    described = relations.join(comments, "objoid").drop("objoid")
    joined = table_columns(info_columns, info_views, schemas).join(
        described, ["table_schema", "table_name", "ordinal_position"], "left"
    )
    return shaped_columns(joined, F.col("description"))


def segments(
    pg_class: DataFrame, pg_namespace: DataFrame, schemas: Sequence[str]
) -> DataFrame:
    kind = F.col("relkind")
    segment_type = None
    for code, name in RELATION_KINDS.items():
        segment_type = (
            F.when(kind == code, name) if segment_type is None
            else segment_type.when(kind == code, name)
        )
    kept = _relations(pg_class.filter(kind.isin(*RELATION_KINDS)), pg_namespace, schemas)
    return shaped(
        kept,
        "segments",
        owner_nm=F.col("table_schema"),
        segment_nm=F.col("relname"),
        partition_nm=F.lit(NO_PARTITION),
        segment_type=segment_type,
        head_block_cnt=F.lit(0),
        segment_size=F.col("size_bytes"),
        block_cnt=F.lit(0),
    )


def indexes(
    pg_index: DataFrame,
    pg_class: DataFrame,
    pg_namespace: DataFrame,
    pg_am: DataFrame,
    pg_tablespace: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    tables_ = _relations(pg_class, pg_namespace, schemas).select(
        F.col("oid").alias("indrelid"), "table_schema", F.col("relname").alias("table_name")
    )
    index_relations = pg_class.select(
        F.col("oid").alias("indexrelid"),
        F.col("relname").alias("index_name"),
        "relam",
        "reltablespace",
    )
    methods = pg_am.select(F.col("oid").alias("relam"), "amname")
    spaces = pg_tablespace.select(F.col("oid").alias("reltablespace"), "spcname")
    joined = (
        pg_index.join(tables_, "indrelid")
        .join(index_relations, "indexrelid")
        .join(methods, "relam")
        .join(spaces, "reltablespace", "left")
    )
    return shaped(
        joined,
        "indexes",
        owner_nm=F.col("table_schema"),
        index_nm=F.col("index_name"),
        tab_nm=F.col("table_name"),
        index_type=F.col("amname"),
        uniqueness=F.when(F.col("indisunique"), "UNIQUE").otherwise("NONUNIQUE"),
        part_yn=F.lit("N"),
        status=F.when(F.col("indisvalid"), "VALID").otherwise("UNUSABLE"),
        tablespace_nm=F.col("spcname"),
    )


def index_owners(pg_indexes: DataFrame) -> DataFrame:
    """Indexes with the schema of their table: always their own schema here."""
    return pg_indexes.select(
        F.col("schemaname").alias("owner_nm"),
        F.col("indexname").alias("index_nm"),
        F.col("schemaname").alias("tab_owner_nm"),
        F.col("tablename").alias("tab_nm"),
    )
