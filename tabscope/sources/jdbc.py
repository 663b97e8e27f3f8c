"""Reader options for relational sources.

Each function returns the options of Spark's JDBC reader. Credentials are passed in
by the caller or taken from environment variables the caller names; none live here.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Default port and driver class of each vendor.
PORTS = {"oracle": 1521, "postgres": 5432, "mssql": 1433, "mysql": 3306}
DRIVERS = {
    "oracle": "oracle.jdbc.OracleDriver",
    "postgres": "org.postgresql.Driver",
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "mysql": "org.mariadb.jdbc.Driver",
}
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Credentials:
    user: str
    password: str = field(repr=False)

    @classmethod
    def from_env(cls, user_var: str, password_var: str) -> "Credentials":
        return cls(os.environ[user_var], os.environ[password_var])


def _options(vendor: str, url: str, credentials: Credentials | None) -> dict[str, str]:
    options = {"url": url, "driver": DRIVERS[vendor], "fetchsize": str(FETCH_ROWS)}
    if credentials is not None:
        options |= {"user": credentials.user, "password": credentials.password}
    return options


def oracle(
    host: str,
    port: int = PORTS["oracle"],
    service_name: str = "",
    sid: str = "",
    credentials: Credentials | None = None,
) -> dict[str, str]:
    """A service name takes precedence over a SID; one of them is needed."""
    if service_name:
        url = f"jdbc:oracle:thin:@//{host}:{port}/{service_name}"
    elif sid:
        url = f"jdbc:oracle:thin:@{host}:{port}:{sid}"
    else:
        raise ValueError("an Oracle source needs service_name or sid")
    return _options("oracle", url, credentials)


def postgres(
    host: str = "localhost",
    port: int = PORTS["postgres"],
    database: str = "",
    credentials: Credentials | None = None,
) -> dict[str, str]:
    return _options("postgres", f"jdbc:postgresql://{host}:{port}/{database}", credentials)


def mssql(
    host: str,
    port: int = PORTS["mssql"],
    database: str = "",
    driver: str = "",
    credentials: Credentials | None = None,
) -> dict[str, str]:
    options = _options(
        "mssql", f"jdbc:sqlserver://{host}:{port};databaseName={database}", credentials
    )
    return options | ({"driver": driver} if driver else {})


def mysql(
    host: str,
    port: int = PORTS["mysql"],
    database: str = "",
    charset: str = "utf8mb4",
    credentials: Credentials | None = None,
) -> dict[str, str]:
    """MariaDB and MySQL. Both 4-byte and plain utf8 are UTF-8 on the Java side."""
    encoding = "UTF-8" if charset.lower().startswith("utf8") else charset
    url = f"jdbc:mariadb://{host}:{port}/{database}?useUnicode=true&characterEncoding={encoding}"
    return _options("mysql", url, credentials)


def split_read(
    column: str, lower: str | int, upper: str | int, partitions: int
) -> dict[str, str]:
    """Options that read a table in parallel ranges of one column.

    The bounds only place the cuts; rows outside them are read by the first and the
    last range.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


# What each vendor puts around a name.
QUOTES = {"oracle": '""', "postgres": '""', "mssql": "[]", "mysql": "``"}


def quoted(vendor: str, *names: str) -> str:
    """A qualified name as the vendor reads it, whatever case or characters it holds."""
    first, last = QUOTES[vendor]
    return ".".join(f"{first}{name.replace(last, last * 2)}{last}" for name in names)


def bounds_query(vendor: str, owner: str, table: str, column: str) -> str:
    """The SELECT that asks a source for the range of a split column."""
    key = quoted(vendor, column)
    source = quoted(vendor, owner, table)
    return f"SELECT MIN({key}) AS lower_bound, MAX({key}) AS upper_bound FROM {source}"


def count_query(vendor: str, owner: str, table: str) -> str:
    """The SELECT that has the source count its rows."""
    return f"SELECT COUNT(*) AS tab_cnt FROM {quoted(vendor, owner, table)}"


def split_by_key(
    spark: SparkSession,
    options: Mapping[str, str],
    vendor: str,
    owner: str,
    table: str,
    column: str,
    partitions: int,
) -> dict[str, str]:
    """Split options with the bounds the source gives; none for a table without rows."""
    query = bounds_query(vendor, owner, table, column)
    row = read_query(spark, options, query).first()
    low, high = row[0], row[1]
    if low is None:
        return {}
    return split_read(quoted(vendor, column), str(low), str(high), partitions)


def schema_predicates(column: str, schemas: Sequence[str]) -> list[str]:
    """One condition per schema: each is a partition the source filters by itself."""
    return ["{} = '{}'".format(column, s.replace("'", "''")) for s in schemas]


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    split: Mapping[str, str] | None = None,
) -> DataFrame:
    return spark.read.format("jdbc").options(**options, **(split or {})).option(
        "dbtable", table
    ).load()


def read_query(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    """A SELECT the source itself runs."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


# Where each catalog extract comes from, as a ``dbtable``. Sizes that exist only as
# server functions are asked for in a subquery.
CATALOGS = {
    "oracle": {
        "all_tables": "ALL_TABLES",
        "all_tab_comments": "ALL_TAB_COMMENTS",
        "dba_segments": "DBA_SEGMENTS",
        "all_tab_columns": "ALL_TAB_COLUMNS",
        "all_col_comments": "ALL_COL_COMMENTS",
        "all_views": "ALL_VIEWS",
        "all_constraints": "ALL_CONSTRAINTS",
        "all_cons_columns": "ALL_CONS_COLUMNS",
        "all_indexes": "ALL_INDEXES",
    },
    "postgres": {
        "info_tables": "information_schema.tables",
        "info_columns": "information_schema.columns",
        "info_views": "information_schema.views",
        "table_constraints": "information_schema.table_constraints",
        "key_column_usage": "information_schema.key_column_usage",
        "pg_class": (
            "(SELECT oid, relname, relnamespace, relkind::text AS relkind, reltablespace, relam, "
            "pg_relation_size(oid) AS size_bytes, pg_total_relation_size(oid) AS total_bytes "
            "FROM pg_class) c"
        ),
        "pg_namespace": "(SELECT oid, nspname FROM pg_namespace) n",
        "pg_tablespace": "(SELECT oid, spcname FROM pg_tablespace) s",
        "pg_stat": "pg_stat_all_tables",
        "pg_description": (
            "(SELECT objoid, classoid::regclass::text AS classname, objsubid, description "
            "FROM pg_description) d"
        ),
        "pg_index": "(SELECT indexrelid, indrelid, indisunique, indisvalid FROM pg_index) i",
        "pg_am": "(SELECT oid, amname FROM pg_am) a",
    },
    "mysql": {
        "info_tables": "information_schema.TABLES",
        "info_columns": "information_schema.COLUMNS",
        "info_views": "information_schema.VIEWS",
        "table_constraints": "information_schema.TABLE_CONSTRAINTS",
        "key_column_usage": "information_schema.KEY_COLUMN_USAGE",
        "statistics": "information_schema.STATISTICS",
    },
    "mssql": {
        "sys_tables": "sys.tables",
        "sys_schemas": "sys.schemas",
        "sys_columns": "sys.columns",
        "sys_types": "sys.types",
        "sys_indexes": "sys.indexes",
        "partitions": "sys.partitions",
        "allocation_units": "sys.allocation_units",
        "default_constraints": "sys.default_constraints",
        "extended_properties": (
            "(SELECT major_id, minor_id, name, CAST(value AS NVARCHAR(MAX)) AS value "
            "FROM sys.extended_properties) p"
        ),
        "table_constraints": "INFORMATION_SCHEMA.TABLE_CONSTRAINTS",
        "key_column_usage": "INFORMATION_SCHEMA.KEY_COLUMN_USAGE",
    },
}


# The column of an extract that holds the schema, where it has one.
SCHEMA_COLUMNS = {
    "oracle": {name: "OWNER" for name in CATALOGS["oracle"]},
    "postgres": {
        **{n: "table_schema" for n in ("info_tables", "info_columns", "info_views")},
        **{n: "table_schema" for n in ("table_constraints", "key_column_usage")},
        "pg_stat": "schemaname",
    },
    "mysql": {name: "TABLE_SCHEMA" for name in CATALOGS["mysql"]},
    "mssql": {n: "TABLE_SCHEMA" for n in ("table_constraints", "key_column_usage")},
}


def catalog_extracts(
    spark: SparkSession,
    options: Mapping[str, str],
    vendor: str,
    schemas: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """A vendor's catalog extracts, ready for the dictionary normalisers.

    With ``schemas`` the extracts that name a schema are read by one task per schema and
    filtered by the source; without, and for the others, one task reads all.
    """

    def read(name: str, source: str) -> DataFrame:
        column = SCHEMA_COLUMNS[vendor].get(name)
        if not schemas or column is None:
            return read_table(spark, options, source)
        rest = {k: v for k, v in options.items() if k != "url"}
        conditions = schema_predicates(column, schemas)
        return spark.read.jdbc(options["url"], source, predicates=conditions, properties=rest)

    return {name: read(name, source) for name, source in CATALOGS[vendor].items()}
