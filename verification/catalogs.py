"""Catalog extracts derived from the given tables.

The normalisers need catalogs of an estate. Here an order is a table, its priority the
schema, its line items are columns, segments, indexes and constraints, so the estate
grows with the data. Each extract is one SELECT that Spark and the checking engine both
understand; ``{orders}`` and so on stand for the given tables.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from copy import copy

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.shapes import shuffle_partitions
from verification.tables import Frames

#: Schemas to collect. '5-LOW' becomes SYS, which the vendors reserve.
KEPT = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
DB = "estate"

_OWNER = "CASE WHEN o.o_orderpriority = '5-LOW' THEN 'SYS' ELSE o.o_orderpriority END"
_KEY = "CAST(o.o_orderkey AS STRING)"
_LINE = "CAST(l.l_linenumber AS STRING)"
_TABLE = f"'T' || {_KEY}"
_SCHEMA_ID = "CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT)"
_LINES = "FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"
_PER_LINE = "GROUP BY o.o_orderpriority, o.o_orderkey, o.o_orderstatus, l.l_linenumber"
_PCT = "CAST(round({}(l.{}) * 100) AS INT)"
_BYTES = "CAST(floor(l.l_extendedprice) AS BIGINT) * 1048576 + l.l_partkey"
_LINE_TYPE = (
    "CASE WHEN max(l.l_returnflag) = 'A' THEN 'VARCHAR2' "
    "WHEN max(l.l_returnflag) = 'N' THEN 'NUMBER' "
    "WHEN max(l.l_linestatus) = 'F' THEN 'CLOB' ELSE 'string' END"
)

ORACLE = {
    "all_tables": f"""
        SELECT {_OWNER} AS owner, {_TABLE} AS table_name,
               NULLIF(o.o_orderstatus, 'P') AS tablespace_name, o.o_custkey AS num_rows,
               o.o_orderdate AS last_analyzed,
               CASE WHEN o.o_orderstatus = 'F' THEN 'YES' ELSE 'NO' END AS partitioned
        FROM {{orders}} o""",
    "all_tab_comments": f"""
        SELECT {_OWNER} AS owner, {_TABLE} AS table_name,
               CASE WHEN o.o_orderstatus = 'O' THEN 'VIEW' ELSE 'TABLE' END AS table_type,
               CASE WHEN o.o_totalprice >= 100000
                    THEN 'order of customer ' || CAST(o.o_custkey AS STRING) END AS comments
        FROM {{orders}} o WHERE o.o_totalprice > 20000""",
    "dba_segments": f"""
        SELECT {_OWNER} AS owner,
               CASE WHEN l.l_quantity = 1 THEN 'BIN$' || {_KEY}
                    WHEN l.l_returnflag = 'R' AND l.l_linenumber < 7
                    THEN 'I' || {_KEY} || '_' || {_LINE}
                    ELSE {_TABLE} END AS segment_name,
               CASE WHEN l.l_returnflag = 'N' THEN 'P' || {_LINE} END AS partition_name,
               CASE WHEN l.l_returnflag = 'A' THEN 'TABLE'
                    WHEN l.l_returnflag = 'N' THEN 'TABLE PARTITION'
                    WHEN l.l_linestatus = 'F' THEN 'INDEX' ELSE 'LOBSEGMENT' END AS segment_type,
               NULLIF(l.l_linestatus, 'F') AS tablespace_name,
               CASE WHEN l.l_discount > 0 THEN {_BYTES} END AS bytes
        {_LINES}""",
    "all_tab_columns": f"""
        SELECT {_OWNER} AS owner, {_TABLE} AS table_name, 'C' || {_LINE} AS column_name,
               l.l_linenumber * 10 AS column_id, {_LINE_TYPE} AS data_type,
               CAST(max(l.l_quantity) AS INT) AS data_length,
               CASE WHEN min(l.l_discount) = 0 THEN 'N' ELSE 'Y' END AS nullable,
               NULLIF({_PCT.format("max", "l_discount")}, 5) AS data_precision,
               NULLIF({_PCT.format("min", "l_tax")}, 3) AS data_scale,
               NULLIF(max(l.l_linestatus), 'F') AS data_default
        {_LINES} {_PER_LINE}""",
    "all_col_comments": f"""
        SELECT {_OWNER} AS owner, {_TABLE} AS table_name, 'C' || {_LINE} AS column_name,
               CASE WHEN max(l.l_tax) > 0 THEN 'line ' || {_LINE} END AS comments
        {_LINES} {_PER_LINE} HAVING max(l.l_quantity) > 3""",
    "all_views": f"""
        SELECT {_OWNER} AS owner, {_TABLE} AS view_name
        FROM {{orders}} o WHERE o.o_orderstatus = 'O'""",
    "all_constraints": f"""
        SELECT {_OWNER} AS owner,
               CASE WHEN max(l.l_quantity) < 3 THEN 'BIN$' || {_KEY} ELSE {_TABLE} END
                   AS table_name,
               'K' || {_KEY} || '_' || {_LINE} AS constraint_name,
               CASE WHEN l.l_linenumber = 1 THEN 'P' WHEN l.l_linenumber = 2 THEN 'U'
                    WHEN l.l_linenumber = 3 THEN 'R' ELSE 'C' END AS constraint_type,
               CASE WHEN min(l.l_discount) = 0 THEN 'DISABLED' ELSE 'ENABLED' END AS status
        {_LINES} {_PER_LINE}""",
    "all_cons_columns": f"""
        SELECT {_OWNER} AS owner, {_TABLE} AS table_name,
               'K' || {_KEY} || '_'
                   || CASE WHEN l.l_linenumber <= 3 THEN '1' ELSE CAST(l.l_linenumber - 2 AS STRING) END
                   AS constraint_name,
               'C' || {_LINE} AS column_name,
               NULLIF(l.l_linenumber, 3) AS position
        {_LINES} {_PER_LINE}""",
    "all_indexes": f"""
        SELECT {_OWNER} AS owner, 'I' || {_KEY} || '_' || {_LINE} AS index_name,
               CASE WHEN o.o_orderstatus = 'O' THEN 'SYS' ELSE {_OWNER} END AS table_owner,
               {_TABLE} AS table_name,
               CASE WHEN max(l.l_returnflag) = 'A' THEN 'BITMAP' ELSE 'NORMAL' END AS index_type,
               CASE WHEN l.l_linenumber = 1 THEN 'UNIQUE' ELSE 'NONUNIQUE' END AS uniqueness,
               CASE WHEN o.o_orderstatus = 'F' THEN 'YES' ELSE 'NO' END AS partitioned,
               CASE WHEN min(l.l_discount) = 0 THEN 'UNUSABLE' ELSE 'VALID' END AS status,
               NULLIF(max(l.l_linestatus), 'F') AS tablespace_name
        {_LINES} {_PER_LINE}""",
    "all_users": f"SELECT DISTINCT {_OWNER} AS username FROM {{orders}} o",
    "dba_objects": f"""
        SELECT {_OWNER} AS owner, {_TABLE} AS object_name,
               CASE WHEN l.l_returnflag = 'A' THEN 'TABLE'
                    WHEN l.l_returnflag = 'N' THEN 'TABLE PARTITION' ELSE 'INDEX' END AS object_type,
               l.l_shipdate AS created
        {_LINES}""",
}

ANSI = {
    "info_tables": f"""
        SELECT o.o_orderpriority AS table_schema, {_TABLE} AS table_name,
               CASE WHEN o.o_orderstatus = 'O' THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
               CASE WHEN o.o_totalprice >= 100000
                    THEN 'order of customer ' || CAST(o.o_custkey AS STRING) END AS table_comment,
               o.o_custkey AS table_rows, o.o_orderdate AS update_time,
               CAST(floor(o.o_totalprice) AS BIGINT) * 10007 AS data_length,
               CASE WHEN o.o_orderstatus = 'P' THEN CAST(NULL AS BIGINT)
                    ELSE o.o_custkey * 1013 END AS index_length
        FROM {{orders}} o""",
    "info_columns": f"""
        SELECT o.o_orderpriority AS table_schema, {_TABLE} AS table_name,
               'C' || {_LINE} AS column_name, l.l_linenumber AS ordinal_position,
               lower({_LINE_TYPE}) AS data_type,
               CASE WHEN max(l.l_returnflag) = 'A' THEN CAST(max(l.l_quantity) AS INT) END
                   AS character_maximum_length,
               CASE WHEN max(l.l_returnflag) = 'N'
                    THEN {_PCT.format("max", "l_discount")} END AS numeric_precision,
               CASE WHEN max(l.l_returnflag) = 'N'
                    THEN {_PCT.format("min", "l_tax")} END AS numeric_scale,
               CASE WHEN max(l.l_linestatus) = 'O' THEN 6 END AS datetime_precision,
               CASE WHEN min(l.l_discount) = 0 THEN 'NO' ELSE 'YES' END AS is_nullable,
               NULLIF(max(l.l_linestatus), 'F') AS column_default,
               CASE WHEN max(l.l_tax) > 0 THEN 'line ' || {_LINE} END AS column_comment
        {_LINES} {_PER_LINE}""",
    "info_views": f"""
        SELECT o.o_orderpriority AS table_schema, {_TABLE} AS table_name
        FROM {{orders}} o WHERE o.o_orderstatus = 'O'""",
    # Constraint names repeat across tables, as MySQL's PRIMARY does.
    "table_constraints": f"""
        SELECT o.o_orderpriority AS table_schema, {_TABLE} AS table_name,
               CASE WHEN l.l_linenumber = 1 THEN 'PRIMARY' ELSE 'K' || {_LINE} END
                   AS constraint_name,
               CASE WHEN l.l_linenumber = 1 THEN 'PRIMARY KEY' WHEN l.l_linenumber = 2 THEN 'UNIQUE'
                    WHEN l.l_linenumber = 3 THEN 'FOREIGN KEY' ELSE 'CHECK' END AS constraint_type
        {_LINES} {_PER_LINE}""",
    "key_column_usage": f"""
        SELECT o.o_orderpriority AS table_schema, {_TABLE} AS table_name,
               CASE WHEN l.l_linenumber <= 3 THEN 'PRIMARY'
                    ELSE 'K' || CAST(l.l_linenumber - 2 AS STRING) END AS constraint_name,
               'C' || {_LINE} AS column_name, l.l_linenumber AS ordinal_position
        {_LINES} {_PER_LINE}""",
    "statistics": f"""
        SELECT o.o_orderpriority AS table_schema, {_TABLE} AS table_name,
               'I' || {_KEY} || '_' || CASE WHEN l.l_linenumber <= 4 THEN '1' ELSE {_LINE} END
                   AS index_name,
               'BTREE' AS index_type, CASE WHEN l.l_linenumber <= 4 THEN 0 ELSE 1 END AS non_unique,
               'C' || {_LINE} AS column_name
        {_LINES}""",
}

POSTGRES = {
    "pg_namespace": f"""
        SELECT DISTINCT {_SCHEMA_ID} AS oid, o.o_orderpriority AS nspname FROM {{orders}} o""",
    "pg_class": f"""
        SELECT o.o_orderkey * 10 AS oid, {_TABLE} AS relname, {_SCHEMA_ID} AS relnamespace,
               CASE WHEN o.o_orderstatus = 'F' THEN 'p' WHEN o.o_orderstatus = 'P' THEN 'r'
                    ELSE 'v' END AS relkind,
               CASE WHEN o.o_orderstatus = 'P' THEN CAST(99 AS BIGINT) ELSE {_SCHEMA_ID} END
                   AS reltablespace,
               CAST(0 AS BIGINT) AS relam,
               CAST(floor(o.o_totalprice) AS BIGINT) * 8192 AS size_bytes,
               CAST(floor(o.o_totalprice) AS BIGINT) * 20011 AS total_bytes
        FROM {{orders}} o
        UNION ALL
        SELECT o.o_orderkey * 10 + l.l_linenumber, 'I' || {_KEY} || '_' || {_LINE}, {_SCHEMA_ID},
               CASE WHEN max(l.l_returnflag) = 'A' THEN 'i' WHEN max(l.l_returnflag) = 'N' THEN 'I'
                    ELSE 'S' END,
               CASE WHEN max(l.l_linestatus) = 'F' THEN CAST(99 AS BIGINT) ELSE {_SCHEMA_ID} END,
               CAST(min(l.l_linenumber) - 1 AS BIGINT),
               CAST(max(l.l_partkey) AS BIGINT) * 8192, CAST(max(l.l_partkey) AS BIGINT) * 8192
        {_LINES} {_PER_LINE}""",
    "pg_tablespace": "SELECT CAST(n.n_nationkey AS BIGINT) AS oid, n.n_name AS spcname FROM {nation} n",
    "pg_am": "SELECT CAST(r.r_regionkey AS BIGINT) AS oid, r.r_name AS amname FROM {region} r",
    "pg_stat": f"""
        SELECT o.o_orderpriority AS schemaname, {_TABLE} AS relname, o.o_orderkey * 10 AS relid,
               o.o_custkey AS n_live_tup, o.o_orderdate AS last_analyze
        FROM {{orders}} o WHERE o.o_totalprice > 50000""",
    "pg_description": f"""
        SELECT o.o_orderkey * 10 AS objoid, 'pg_class' AS classname, 0 AS objsubid,
               'table ' || {_KEY} AS description
        FROM {{orders}} o WHERE o.o_totalprice >= 100000
        UNION ALL
        SELECT o.o_orderkey * 10, 'pg_proc', 0, 'function ' || {_KEY}
        FROM {{orders}} o WHERE o.o_totalprice >= 150000
        UNION ALL
        SELECT o.o_orderkey * 10, 'pg_class', l.l_linenumber, 'line ' || {_LINE}
        {_LINES} {_PER_LINE} HAVING max(l.l_tax) > 0.01""",
    "pg_index": f"""
        SELECT o.o_orderkey * 10 + l.l_linenumber AS indexrelid, o.o_orderkey * 10 AS indrelid,
               l.l_linenumber = 1 AS indisunique, min(l.l_discount) > 0 AS indisvalid
        {_LINES} {_PER_LINE}""",
    "pg_indexes": f"""
        SELECT o.o_orderpriority AS schemaname, {_TABLE} AS tablename,
               'I' || {_KEY} || '_' || {_LINE} AS indexname
        {_LINES} {_PER_LINE}""",
}

MSSQL = {
    "sys_schemas": f"""
        SELECT DISTINCT {_SCHEMA_ID} AS schema_id, o.o_orderpriority AS name FROM {{orders}} o""",
    "sys_tables": f"""
        SELECT o.o_orderkey AS object_id, {_SCHEMA_ID} AS schema_id, {_TABLE} AS name
        FROM {{orders}} o""",
    "sys_columns": f"""
        SELECT o.o_orderkey AS object_id, l.l_linenumber AS column_id, 'C' || {_LINE} AS name,
               CASE WHEN max(l.l_returnflag) = 'A' THEN 1 WHEN max(l.l_returnflag) = 'N' THEN 2
                    ELSE 77 END AS user_type_id,
               NULLIF(CAST(max(l.l_quantity) AS INT), 50) AS max_length,
               {_PCT.format("max", "l_discount")} AS precision,
               {_PCT.format("min", "l_tax")} AS scale,
               CASE WHEN min(l.l_discount) = 0 THEN 0 ELSE 1 END AS is_nullable
        {_LINES} {_PER_LINE}""",
    "sys_types": "SELECT r.r_regionkey AS user_type_id, r.r_name AS name FROM {region} r",
    "extended_properties": f"""
        SELECT o.o_orderkey AS major_id, 0 AS minor_id,
               CASE WHEN o.o_orderstatus = 'P' THEN 'Other' ELSE 'MS_Description' END AS name,
               'table ' || {_KEY} AS value
        FROM {{orders}} o
        UNION ALL
        SELECT o.o_orderkey, l.l_linenumber, 'MS_Description', 'line ' || {_LINE}
        {_LINES} {_PER_LINE} HAVING max(l.l_tax) > 0.01""",
    "partitions": f"""
        SELECT o.o_orderkey AS object_id, l.l_linenumber - 1 AS index_id,
               o.o_orderkey * 10 + l.l_linenumber AS partition_id,
               CAST(max(l.l_quantity) AS BIGINT) AS rows
        {_LINES} {_PER_LINE}""",
    "allocation_units": """
        SELECT l.l_orderkey * 10 + l.l_linenumber AS container_id, l.l_partkey AS total_pages
        FROM {lineitem} l WHERE l.l_quantity > 2""",
    "default_constraints": f"""
        SELECT o.o_orderkey AS parent_object_id, l.l_linenumber AS parent_column_id,
               '((' || {_LINE} || '))' AS definition
        {_LINES} {_PER_LINE} HAVING max(l.l_linestatus) = 'O'""",
    "sys_indexes": f"""
        SELECT o.o_orderkey AS object_id,
               CASE WHEN max(l.l_returnflag) <> 'A' THEN 'I' || {_KEY} || '_' || {_LINE} END AS name,
               CASE WHEN l.l_linenumber = 1 THEN 'CLUSTERED' ELSE 'NONCLUSTERED' END AS type_desc,
               CASE WHEN l.l_linenumber = 1 THEN 1 ELSE 0 END AS is_unique,
               CASE WHEN min(l.l_discount) = 0 THEN 1 ELSE 0 END AS is_disabled
        {_LINES} {_PER_LINE}""",
}

# The common dictionary and two earlier registrations, for the registration operators.
# Orders up to 1997 are an older snapshot (1); the newest snapshot (2) has them all.
_SNAP = f"2 AS chasu, '{DB}' AS db_nm, {_OWNER} AS owner_nm"
DICTIONARY = {
    "dic_snapshots": f"""
        SELECT CASE WHEN o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END AS chasu,
               '{DB}' AS db_nm, max(o.o_orderdate) AS cr_dt
        FROM {{orders}} o
        GROUP BY CASE WHEN o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END""",
    "dic_tables": f"""
        SELECT {_SNAP}, {_TABLE} AS tab_nm,
               CASE WHEN o.o_totalprice >= 100000 THEN 'table ' || {_KEY} ELSE '' END AS tab_comment,
               CASE WHEN o.o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS part_yn
        FROM {{orders}} o""",
    "dic_columns": f"""
        SELECT {_SNAP}, {_TABLE} AS tab_nm, 'C' || {_LINE} AS col_nm, 'line ' || {_LINE} AS col_comment,
               l.l_linenumber * 10 AS col_seq, {_LINE_TYPE} AS data_type,
               CAST(max(l.l_quantity) AS BIGINT) AS data_len,
               CASE WHEN min(l.l_discount) = 0 THEN 'N' ELSE 'Y' END AS null_yn,
               {_PCT.format("max", "l_discount")} AS data_precision,
               {_PCT.format("min", "l_tax")} AS data_scale
        {_LINES} {_PER_LINE}""",
    "dic_segments": f"""
        SELECT {_SNAP},
               CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber < 7
                    THEN 'I' || {_KEY} || '_' || {_LINE} ELSE {_TABLE} END AS segment_nm,
               CASE WHEN l.l_returnflag = 'A' THEN 'TABLE'
                    WHEN l.l_returnflag = 'N' THEN 'TABLE PARTITION'
                    WHEN l.l_linestatus = 'F' AND l.l_linenumber % 2 = 0 THEN 'INDEX PARTITION'
                    ELSE 'INDEX' END AS segment_type,
               {_BYTES} AS segment_size
        {_LINES}""",
    "dic_constraints": f"""
        SELECT {_SNAP},
               CASE WHEN l.l_linenumber = 1 THEN 'PRIMARY' ELSE 'K' || {_LINE} END AS cons_nm,
               CASE WHEN l.l_linenumber = 1 THEN 'P' WHEN l.l_linenumber = 2 THEN 'U' ELSE 'R' END
                   AS cons_type,
               {_TABLE} AS table_nm
        {_LINES} {_PER_LINE}""",
    "dic_constraint_columns": f"""
        SELECT {_SNAP},
               CASE WHEN l.l_linenumber <= 3 THEN 'PRIMARY'
                    ELSE 'K' || CAST(l.l_linenumber - 2 AS STRING) END AS cons_nm,
               {_TABLE} AS table_nm, 'C' || {_LINE} AS col_nm, l.l_linenumber AS pos
        {_LINES} {_PER_LINE}""",
    "dic_indexes": f"""
        SELECT {_SNAP}, 'I' || {_KEY} || '_' || {_LINE} AS index_nm, {_TABLE} AS tab_nm
        {_LINES} {_PER_LINE}""",
    "old_tables": f"""
        SELECT CASE WHEN o.o_orderstatus = 'P' THEN 'P02' ELSE 'P01' END AS prfl_id,
               '{DB}' AS db_nm, {_OWNER} AS owner_nm, {_TABLE} AS tab_nm, 'old' AS tab_comment,
               CASE WHEN o.o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS use_yn, 1 AS chasu,
               o.o_orderdate AS cr_dt, o.o_custkey AS tab_cnt
        FROM {{orders}} o WHERE o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00'""",
    "old_columns": f"""
        SELECT CASE WHEN o.o_orderstatus = 'P' THEN 'P02' ELSE 'P01' END AS prfl_id,
               '{DB}' AS db_nm, {_OWNER} AS owner_nm, {_TABLE} AS tab_nm, 'C' || {_LINE} AS col_nm,
               'old' AS col_comment, CASE WHEN o.o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS use_yn,
               1 AS chasu, min(o.o_orderdate) AS cr_dt, 'NUMBER' AS col_data_type,
               CASE WHEN max(l.l_tax) > 0.05 THEN 'B' END AS colval_exec_typ,
               max(l.l_partkey) AS notnull_cnt
        {_LINES} WHERE o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' {_PER_LINE}""",
}

EXTRACTS = ORACLE | ANSI | POSTGRES | MSSQL | DICTIONARY

_TABLE_MARK = re.compile(r"\{(\w+)\}")

#: Bytes of the files of lines and orders that one task joins and groups, which bounds its
#: memory whatever the size; few files are dealt over the session's tasks down to the lesser.
TASK_BYTES = 8 << 20
LEAST_TASK_BYTES = 1 << 20


def _line_tasks(frames: Frames) -> int:
    """Tasks that lines and orders are dealt over: as many more as there is more to join."""
    size = frames.bytes("lineitem") + frames.bytes("orders")
    spread = min(shuffle_partitions(frames.spark), -(-size // LEAST_TASK_BYTES))
    return max(1, -(-size // TASK_BYTES), spread)


#: What lines are grouped by, in the order they are sorted in: first the key they are dealt by.
_LINE_KEY = ("o_orderkey", "l_linenumber", "o_orderpriority", "o_orderstatus")
_EXTREME = re.compile(r"\b(max|min)\(l\.(\w+)\)")


def _dealt(frames: Frames) -> tuple[DataFrame, DataFrame]:
    """Lines and orders, each dealt by the key of the order."""
    tasks = _line_tasks(frames)
    return (
        frames["lineitem"].repartition(tasks, "l_orderkey"),
        frames["orders"].repartition(tasks, "o_orderkey"),
    )


def _of_lines(query: str) -> bool:
    """Whether an extract has a row per line with its order."""
    return _LINES in query and "GROUP BY" not in query


def _of_groups(query: str) -> bool:
    """Whether an extract has a row per order and number of a line, and reads nothing else."""
    return query.count("FROM") == 1 and f"{_LINES} {_PER_LINE}" in query


@contextmanager
def lines_at_hand(frames: Frames, *names: str) -> Iterator[Frames]:
    """The tables, with lines and their orders joined and grouped once for the named extracts.

    Inside the block, extracts made from the frames given read these rows from the
    executors' disks in place of joining and grouping the tables each for itself.
    """
    queries = [EXTRACTS[n] for n in names]
    groups = "".join(filter(_of_groups, queries))
    used = re.findall(r"\b[lo]\.(\w+)", groups + "".join(filter(_of_lines, queries)))
    lines, orders = _dealt(frames)
    joined = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .select(*sorted({*used, *_LINE_KEY}))
        .sortWithinPartitions(*_LINE_KEY)
        .persist(StorageLevel.DISK_ONLY)
    )
    out, view = copy(frames), uuid.uuid4().hex
    out.lines, out.groups = f"lines_{view}", f"groups_{view}"
    kept = {out.lines: joined}
    try:
        # Spark knows how rows are dealt and sorted only once they are there.
        joined.count()
        extremes = sorted(set(_EXTREME.findall(groups)))
        kept[out.groups] = (
            joined.groupBy(*_LINE_KEY)
            .agg(*[getattr(F, f)(c).alias(f"{f}_{c}") for f, c in extremes])
            .persist(StorageLevel.DISK_ONLY)
        )
        for name, rows in kept.items():
            rows.createOrReplaceTempView(name)
        yield out
    finally:
        for name, rows in kept.items():
            rows.unpersist(blocking=True)
            frames.spark.catalog.dropTempView(name)


def extract(frames: Frames, name: str) -> DataFrame:
    """One extract as Spark derives it.

    Lines meet their order where both are dealt by its key; an order's lines stay together,
    so they are grouped there too.
    """
    query = EXTRACTS[name]
    if frames.lines and _of_lines(query):
        query = query.replace(_LINES, f"FROM {frames.lines} l")
        return frames.spark.sql(re.sub(r"\bo\.", "l.", query))
    if frames.groups and _of_groups(query):
        query = query.replace(f"{_LINES} {_PER_LINE}", f"FROM {frames.groups} l")
        query = _EXTREME.sub(r"l.\1_\2", query).replace(" HAVING ", " WHERE ")
        return frames.spark.sql(re.sub(r"\bo\.", "l.", query))
    used = {t: frames[t] for t in _TABLE_MARK.findall(query)}
    if _LINES in query:
        query = query.replace(_LINES, _LINES.replace("{orders}", "{dealt_orders}"))
        used["lineitem"], used["dealt_orders"] = _dealt(frames)
    return frames.spark.sql(query, **used)


def extracts(frames: Frames, *names: str) -> list[DataFrame]:
    return [extract(frames, name) for name in names]


def with_extracts(names: Iterable[str], query: str) -> str:
    """The checking query, with its extracts in front."""
    parts = [f"{n} AS ({_TABLE_MARK.sub(lambda m: m.group(1), EXTRACTS[n])})" for n in names]
    joined = ",\n".join(parts)
    body = query.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {joined},\n{body[5:]}"
    return f"WITH {joined}\n{body}"
