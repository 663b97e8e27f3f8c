"""Shapes and rules shared by the vendor normalisers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.operators.shapes import TEXT_ROW, bounded_broadcast

# Schemas each vendor reserves for itself.
SYSTEM_SCHEMAS = {
    "oracle": (
        "SYS", "SYSCAT", "SYSGIS", "SYSTEM", "OUTLN", "DBSNMP", "APPQOSSYS", "WMSYS", "XDB",
    ),
    "postgres": ("pg_catalog", "information_schema", "pg_toast"),
    "mysql": ("information_schema", "performance_schema", "mysql", "sys"),
    "mssql": ("master", "tempdb", "model", "msdb"),
}

# Dictionary codes.
NO_PARTITION = "NOPART"
RECYCLE_BIN_PREFIX = "BIN$"
TABLE_SEGMENTS = ("TABLE", "TABLE PARTITION")
INDEX_SEGMENTS = ("INDEX", "INDEX PARTITION")
CONSTRAINT_CODES = {"PRIMARY KEY": "P", "UNIQUE": "U", "FOREIGN KEY": "R"}

KIB = 1024
MIB = 1024 * 1024
GIB = 1024 * 1024 * 1024

#: Column types of the common dictionary, by object.
DICTIONARY_TYPES: dict[str, dict[str, str]] = {
    "tables": {
        "owner_nm": "string", "tab_nm": "string", "tab_comment": "string",
        "tablespace_nm": "string", "row_cnt": "bigint", "last_analyzed_dt": "timestamp_ntz",
        "part_yn": "string", "tab_mb_size": "decimal(18,2)", "tab_gb_size": "decimal(18,4)",
    },
    "columns": {
        "owner_nm": "string", "tab_nm": "string", "col_nm": "string", "col_comment": "string",
        "col_seq": "int", "data_type": "string", "data_len": "bigint", "null_yn": "string",
        "data_precision": "int", "data_scale": "int", "def_value": "string",
    },
    "segments": {
        "owner_nm": "string", "segment_nm": "string", "partition_nm": "string",
        "segment_type": "string", "tablespace_nm": "string", "head_block_cnt": "int",
        "segment_size": "bigint", "block_cnt": "int",
    },
    "constraints": {
        "owner_nm": "string", "cons_nm": "string", "cons_type": "string", "table_nm": "string",
        "index_owner_nm": "string", "index_nm": "string",
    },
    "constraint_columns": {
        "owner_nm": "string", "cons_nm": "string", "col_nm": "string", "cons_type": "string",
        "table_nm": "string", "pos": "int",
    },
    "indexes": {
        "owner_nm": "string", "index_nm": "string", "tab_nm": "string", "index_type": "string",
        "uniqueness": "string", "part_yn": "string", "status": "string",
        "tablespace_nm": "string",
    },
}


def shaped(df: DataFrame, kind: str, **values: Column) -> DataFrame:
    """Project to the common columns of ``kind``; columns not given are NULL."""
    types = DICTIONARY_TYPES[kind]
    unknown = set(values) - set(types)
    if unknown:
        raise ValueError(f"not a column of {kind}: {sorted(unknown)}")
    return df.select(
        *[values.get(name, F.lit(None)).cast(t).alias(name) for name, t in types.items()]
    )


def stamped(
    df: DataFrame, db_nm: str, chasu: int, run_date: dt.date | None = None
) -> DataFrame:
    """Add the snapshot columns. ``run_date`` is a parameter so that results repeat."""
    return df.select(
        F.lit(chasu).cast("int").alias("chasu"),
        F.lit(db_nm).alias("db_nm"),
        *df.columns,
        F.lit(run_date).cast("date").alias("cr_dt"),
    )


@dataclass(frozen=True)
class AllBut:
    """In place of a list of schemas: all but the vendor's own and the ones named."""

    vendor: str
    names: tuple[str, ...] = ()


Schemas = Sequence[str] | AllBut


def keep_schemas(df: DataFrame, column: str, schemas: Schemas) -> DataFrame:
    """Rows of the listed schemas; an empty list keeps nothing."""
    if isinstance(schemas, AllBut):
        return drop_system_schemas(df, column, schemas.vendor, schemas.names)
    return df.filter(F.col(column).isin(*schemas) if schemas else F.lit(False))


def schema_names(df: DataFrame, column: str, schemas: Schemas) -> DataFrame:
    """The catalog's own list of schemas, restricted to the wanted ones.

    Objects meet it by schema, which are few: listed ones are hinted for broadcast, so that
    all objects of a schema need not move to one task.
    """
    kept = keep_schemas(df, column, schemas)
    return kept if isinstance(schemas, AllBut) else bounded_broadcast(kept, len(schemas), TEXT_ROW)


def drop_system_schemas(
    df: DataFrame, column: str, vendor: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Rows outside the vendor's own schemas."""
    return df.filter(~F.col(column).isin(*SYSTEM_SCHEMAS[vendor], *extra))


def text_or_empty(comment: Column) -> Column:
    return F.coalesce(comment, F.lit(""))


def yes_no(condition: Column) -> Column:
    """'Y' where the condition holds, 'N' otherwise (also for NULL)."""
    return F.when(condition, "Y").otherwise("N")


def constraint_code(name: Column) -> Column:
    code = None
    for long_name, short in CONSTRAINT_CODES.items():
        code = F.when(name == long_name, short) if code is None else code.when(
            name == long_name, short
        )
    return code


def whole_units(size: Column, unit: int) -> Column:
    """Whole units in a byte count, cut off toward zero; NULL counts as zero."""
    count = F.coalesce(size, F.lit(0)).cast("bigint")
    return F.call_function("div", count, F.lit(unit).cast("bigint"))


def not_recycled(name: Column) -> Column:
    return ~name.startswith(RECYCLE_BIN_PREFIX)
