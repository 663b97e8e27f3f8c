"""A vendor's whole dictionary from its catalog extracts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tabscope.operators.dictionary import ansi, mssql, mysql, oracle, postgres
from tabscope.operators.dictionary.common import Schemas

#: Per vendor and dictionary part: the normaliser and the extracts it takes, in order.
NORMALISERS: dict[str, dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]]] = {
    "oracle": {
        "tables": (oracle.tables, ("all_tables", "all_tab_comments", "dba_segments")),
        "columns": (oracle.columns, ("all_tab_columns", "all_col_comments", "all_views")),
        "segments": (oracle.segments, ("dba_segments",)),
        "constraints": (oracle.constraints, ("all_constraints",)),
        "constraint_columns": (
            oracle.constraint_columns, ("all_cons_columns", "all_constraints"),
        ),
        "indexes": (oracle.indexes, ("all_indexes",)),
    },
    "postgres": {
        "tables": (
            postgres.tables,
            (
                "info_tables", "pg_class", "pg_namespace", "pg_tablespace", "pg_stat",
                "pg_description",
            ),
        ),
        "columns": (
            postgres.columns, ("info_columns", "info_views", "pg_stat", "pg_description"),
        ),
        "segments": (postgres.segments, ("pg_class", "pg_namespace")),
        "constraints": (ansi.constraints, ("table_constraints",)),
        "constraint_columns": (
            ansi.constraint_columns, ("key_column_usage", "table_constraints"),
        ),
        "indexes": (
            postgres.indexes,
            ("pg_index", "pg_class", "pg_namespace", "pg_am", "pg_tablespace"),
        ),
    },
    "mysql": {
        "tables": (mysql.tables, ("info_tables",)),
        "columns": (mysql.columns, ("info_columns", "info_views")),
        "segments": (mysql.segments, ("info_tables",)),
        "constraints": (ansi.constraints, ("table_constraints",)),
        "constraint_columns": (
            ansi.constraint_columns, ("key_column_usage", "table_constraints"),
        ),
        "indexes": (mysql.indexes, ("statistics",)),
    },
    "mssql": {
        "tables": (
            mssql.tables,
            (
                "sys_tables", "sys_schemas", "extended_properties", "partitions",
                "allocation_units",
            ),
        ),
        "columns": (
            mssql.columns,
            (
                "sys_columns", "sys_tables", "sys_schemas", "sys_types", "extended_properties",
                "default_constraints",
            ),
        ),
        "segments": (
            mssql.segments, ("sys_tables", "sys_schemas", "partitions", "allocation_units"),
        ),
        "constraints": (ansi.constraints, ("table_constraints",)),
        "constraint_columns": (
            ansi.constraint_columns, ("key_column_usage", "table_constraints"),
        ),
        "indexes": (mssql.indexes, ("sys_indexes", "sys_tables", "sys_schemas")),
    },
}


def extract_names(vendor: str) -> list[str]:
    """The catalog extracts a vendor's dictionary is made of."""
    names = {n: None for _, takes in NORMALISERS[vendor].values() for n in takes}
    return list(names)


def dictionary_parts(
    vendor: str, extracts: Mapping[str, DataFrame], schemas: Schemas
) -> dict[str, DataFrame]:
    """All dictionary parts of one source, ready for a snapshot.

    ``schemas`` lists those to collect, or is an ``AllBut`` of those to leave out.
    """
    return {
        part: normalise(*[extracts[n] for n in takes], schemas)
        for part, (normalise, takes) in NORMALISERS[vendor].items()
    }
