"""Dictionary normalisers over the derived catalogs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.column_stats import column_stats
from tabscope.operators.dictionary import ansi, lake, legacy, mssql, mysql, oracle, postgres, snapshot
from tabscope.operators.dictionary.common import drop_system_schemas, stamped
from tabscope.operators.dictionary.vendors import dictionary_parts, extract_names
from tabscope.operators.table_stats import row_counts
from tabscope.pipeline import collect_dictionary
from tabscope.session import shared_dir
from verification import profile_sql as sql
from verification.catalogs import DB, KEPT, extract, extracts, lines_at_hand, with_extracts
from verification.checked import Check, comparable, sql_stamp
from verification.inputs import RUN_TS, inputs, profile_input, scratch_store
from verification.tables import SCHEMAS, SPARK_TYPES, Frames

_IN = "(" + ", ".join(f"'{s}'" for s in KEPT) + ")"

_TABLE_COLUMNS = (
    "owner_nm", "tab_nm", "tab_comment", "tablespace_nm", "row_cnt", "last_analyzed_dt",
    "part_yn", "tab_mb_size", "tab_gb_size",
)


def _check(columns, names, normalise, sql) -> Check:
    """A normaliser over its extracts, compared on the given columns."""
    return Check(
        lambda frames: comparable(normalise(*extracts(frames, *names), KEPT), *columns),
        with_extracts(names, sql),
    )


def oracle_parts(frames: Frames) -> dict[str, DataFrame]:
    """All dictionary parts of the derived Oracle estate."""
    found = {name: extract(frames, name) for name in extract_names("oracle")}
    return dictionary_parts("oracle", found, KEPT)


_MB = "CAST({0} // 1048576 AS DOUBLE)"
_GB = "CAST({0} // 1073741824 AS DOUBLE)"
_COLUMN_COLUMNS = (
    "owner_nm", "tab_nm", "col_nm", "col_comment", "col_seq", "data_type", "data_len",
    "null_yn", "data_precision", "data_scale", "def_value",
)
_SEGMENT_COLUMNS = (
    "owner_nm", "segment_nm", "partition_nm", "segment_type", "head_block_cnt", "segment_size",
    "block_cnt",
)
_CONS_COLUMNS = ("owner_nm", "cons_nm", "cons_type", "table_nm")
_CONS_COL_COLUMNS = ("owner_nm", "cons_nm", "col_nm", "cons_type", "table_nm", "pos")
_INDEX_COLUMNS = ("owner_nm", "index_nm", "tab_nm", "index_type", "uniqueness", "part_yn", "status")

_ORACLE_NAMES = ("all_tables", "all_tab_comments", "dba_segments")
_ORACLE_TABLES_SQL = f"""
WITH allocated AS (
    SELECT owner, segment_name, sum(bytes) AS total FROM dba_segments
    WHERE segment_type IN ('TABLE', 'TABLE PARTITION') GROUP BY ALL
), remark AS (SELECT * FROM all_tab_comments WHERE table_type = 'TABLE')
SELECT t.owner AS owner_nm, t.table_name AS tab_nm, ifnull(remark.comments, '') AS tab_comment,
       t.tablespace_name AS tablespace_nm, t.num_rows AS row_cnt,
       {sql_stamp('t.last_analyzed')} AS last_analyzed_dt,
       if(t.partitioned = 'YES', 'Y', 'N') AS part_yn,
       {_MB.format('ifnull(total, 0)')} AS tab_mb_size,
       {_GB.format('ifnull(total, 0)')} AS tab_gb_size
FROM all_tables t
LEFT JOIN remark USING (owner, table_name)
LEFT JOIN allocated ON allocated.owner = t.owner AND segment_name = t.table_name
WHERE t.owner IN {_IN}"""
_ORACLE_SEGMENTS_SQL = f"""
SELECT owner AS owner_nm, segment_name AS segment_nm,
       ifnull(partition_name, 'NOPART') AS partition_nm, segment_type,
       0 AS head_block_cnt, ifnull(bytes, 0) AS segment_size, 0 AS block_cnt, tablespace_name AS tablespace_nm
FROM dba_segments
WHERE owner IN {_IN} AND NOT starts_with(segment_name, 'BIN$')
  AND segment_type IN ('TABLE', 'TABLE PARTITION', 'INDEX', 'INDEX PARTITION')"""
_ANSI_CODES = "(VALUES ('PRIMARY KEY', 'P'), ('UNIQUE', 'U'), ('FOREIGN KEY', 'R')) c(kind, code)"


def _ansi_columns_sql(comment: str, joins: str = "") -> str:
    return f"""
SELECT c.table_schema AS owner_nm, c.table_name AS tab_nm, c.column_name AS col_nm,
       ifnull({comment}, '') AS col_comment, c.ordinal_position AS col_seq, c.data_type,
       coalesce(character_maximum_length, numeric_precision, datetime_precision) AS data_len,
       if(c.is_nullable = 'YES', 'Y', 'N') AS null_yn, numeric_precision AS data_precision,
       numeric_scale AS data_scale, column_default AS def_value
FROM info_columns c {joins}
WHERE c.table_schema IN {_IN}
  AND (c.table_schema, c.table_name) NOT IN (SELECT (table_schema, table_name) FROM info_views)"""


def _normalisers() -> dict[str, Check]:
    out: dict[str, Check] = {}
    out["dic_tables_oracle"] = _check(
        _TABLE_COLUMNS, _ORACLE_NAMES, oracle.tables, _ORACLE_TABLES_SQL
    )
    out["dic_tables_postgres"] = _check(
        _TABLE_COLUMNS,
        ("info_tables", "pg_class", "pg_namespace", "pg_tablespace", "pg_stat", "pg_description"),
        postgres.tables,
        f"""
WITH relation AS (
    SELECT ns.nspname, cl.* FROM pg_class cl JOIN pg_namespace ns ON ns.oid = cl.relnamespace
)
SELECT i.table_schema AS owner_nm, i.table_name AS tab_nm, ifnull(d.description, '') AS tab_comment,
       sp.spcname AS tablespace_nm, st.n_live_tup AS row_cnt,
       {sql_stamp('st.last_analyze')} AS last_analyzed_dt, 'N' AS part_yn,
       {_MB.format('ifnull(r.total_bytes, 0)')} AS tab_mb_size,
       {_GB.format('ifnull(r.total_bytes, 0)')} AS tab_gb_size
FROM info_tables i
LEFT JOIN relation r ON r.nspname = i.table_schema AND r.relname = i.table_name
LEFT JOIN pg_tablespace sp ON sp.oid = r.reltablespace
LEFT JOIN pg_stat st ON (st.schemaname, st.relname) = (i.table_schema, i.table_name)
LEFT JOIN pg_description d ON d.objoid = r.oid AND d.classname = 'pg_class' AND d.objsubid = 0
WHERE i.table_type = 'BASE TABLE' AND i.table_schema IN {_IN}""",
    )
    out["dic_tables_mysql"] = _check(
        tuple(c for c in _TABLE_COLUMNS if c != "tablespace_nm"),
        ("info_tables",),
        mysql.tables,
        f"""
WITH sized AS (SELECT *, ifnull(data_length + index_length, 0)::HUGEINT AS total FROM info_tables)
SELECT table_schema AS owner_nm, table_name AS tab_nm, ifnull(table_comment, '') AS tab_comment,
       table_rows AS row_cnt, {sql_stamp('update_time')} AS last_analyzed_dt, 'N' AS part_yn,
       CAST((total * 200 + 1048576) // 2097152 AS DOUBLE) / 100 AS tab_mb_size,
       CAST((total * 20000 + 1073741824) // 2147483648 AS DOUBLE) / 10000 AS tab_gb_size
FROM sized WHERE table_type = 'BASE TABLE' AND table_schema IN {_IN}""",
    )
    mssql_names = ("sys_tables", "sys_schemas", "extended_properties", "partitions", "allocation_units")
    mssql_columns = ("owner_nm", "tab_nm", "tab_comment", "row_cnt", "part_yn", "tab_mb_size", "tab_gb_size")

    def mssql_sql(units: str) -> str:
        return f"""
WITH remark AS (
    SELECT major_id, value FROM extended_properties WHERE name = 'MS_Description' AND minor_id = 0
), part AS (
    SELECT p.object_id, p.rows, count(u.container_id) AS units, sum(u.total_pages) AS pages
    FROM partitions p LEFT JOIN allocation_units u ON u.container_id = p.partition_id
    WHERE p.index_id < 2 GROUP BY p.object_id, p.partition_id, p.rows
), total AS (
    SELECT object_id, CAST(sum({units}) AS BIGINT) AS row_cnt,
           CAST(sum(pages) AS HUGEINT) * 8 AS kib FROM part GROUP BY object_id
)
SELECT s.name AS owner_nm, t.name AS tab_nm, ifnull(remark.value, '') AS tab_comment, row_cnt,
       'N' AS part_yn, CAST((kib * 200 + 1024) // 2048 AS DOUBLE) / 100 AS tab_mb_size,
       CAST((kib * 20000 + 1048576) // 2097152 AS DOUBLE) / 10000 AS tab_gb_size
FROM sys_tables t JOIN sys_schemas s USING (schema_id)
LEFT JOIN remark ON remark.major_id = t.object_id
LEFT JOIN total ON total.object_id = t.object_id
WHERE s.name IN {_IN}"""

    out["dic_tables_mssql"] = _check(
        mssql_columns, mssql_names, mssql.tables, mssql_sql("rows * greatest(units, 1)")
    )
    out["dic_tables_mssql_rows_once"] = _check(
        mssql_columns,
        mssql_names,
        lambda *args: mssql.tables(*args, rows_per_unit=False),
        mssql_sql("rows"),
    )
    out["dic_columns_oracle"] = _check(
        _COLUMN_COLUMNS,
        ("all_tab_columns", "all_col_comments", "all_views"),
        oracle.columns,
        f"""
SELECT c.owner AS owner_nm, c.table_name AS tab_nm, c.column_name AS col_nm,
       ifnull(m.comments, '') AS col_comment, column_id AS col_seq, data_type,
       data_length AS data_len, nullable AS null_yn, data_precision, data_scale,
       data_default AS def_value
FROM all_tab_columns c LEFT JOIN all_col_comments m USING (owner, table_name, column_name)
WHERE c.owner IN {_IN}
  AND (c.owner, c.table_name) NOT IN (SELECT (owner, view_name) FROM all_views)""",
    )
    out["dic_columns_postgres"] = _check(
        _COLUMN_COLUMNS,
        ("info_columns", "info_views", "pg_stat", "pg_description"),
        postgres.columns,
        _ansi_columns_sql(
            "d.description",
            "LEFT JOIN (pg_stat s JOIN pg_description d "
            "ON d.objoid = s.relid AND d.classname = 'pg_class') "
            "ON s.schemaname = c.table_schema AND s.relname = c.table_name "
            "AND d.objsubid = c.ordinal_position",
        ),
    )
    out["dic_columns_mysql"] = _check(
        _COLUMN_COLUMNS,
        ("info_columns", "info_views"),
        mysql.columns,
        _ansi_columns_sql("c.column_comment"),
    )
    out["dic_columns_mssql"] = _check(
        _COLUMN_COLUMNS,
        (
            "sys_columns", "sys_tables", "sys_schemas", "sys_types", "extended_properties",
            "default_constraints",
        ),
        mssql.columns,
        f"""
WITH remark AS (SELECT * FROM extended_properties WHERE name = 'MS_Description')
SELECT s.name AS owner_nm, t.name AS tab_nm, c.name AS col_nm, ifnull(r.value, '') AS col_comment,
       c.column_id AS col_seq, y.name AS data_type, ifnull(c.max_length, c.precision) AS data_len,
       if(c.is_nullable = 1, 'Y', 'N') AS null_yn, c.precision AS data_precision,
       c.scale AS data_scale, d.definition AS def_value
FROM sys_columns c
JOIN sys_tables t ON t.object_id = c.object_id
JOIN sys_schemas s ON s.schema_id = t.schema_id
JOIN sys_types y ON y.user_type_id = c.user_type_id
LEFT JOIN remark r ON r.major_id = c.object_id AND r.minor_id = c.column_id
LEFT JOIN default_constraints d
       ON (d.parent_object_id, d.parent_column_id) = (c.object_id, c.column_id)
WHERE s.name IN {_IN}""",
    )
    out["dic_segments_oracle"] = _check(
        (*_SEGMENT_COLUMNS, "tablespace_nm"), ("dba_segments",), oracle.segments, _ORACLE_SEGMENTS_SQL
    )
    out["dic_segments_postgres"] = _check(
        _SEGMENT_COLUMNS,
        ("pg_class", "pg_namespace"),
        postgres.segments,
        f"""
WITH kind(code, name) AS (
    VALUES ('r', 'TABLE'), ('p', 'TABLE PARTITION'), ('i', 'INDEX'), ('I', 'INDEX PARTITION')
)
SELECT ns.nspname AS owner_nm, cl.relname AS segment_nm, 'NOPART' AS partition_nm,
       kind.name AS segment_type, 0 AS head_block_cnt, cl.size_bytes AS segment_size, 0 AS block_cnt
FROM pg_class cl
JOIN kind ON kind.code = cl.relkind
JOIN pg_namespace ns ON ns.oid = cl.relnamespace
WHERE ns.nspname IN {_IN}""",
    )
    out["dic_segments_mysql"] = _check(
        _SEGMENT_COLUMNS,
        ("info_tables",),
        mysql.segments,
        f"""
SELECT table_schema AS owner_nm, table_name AS segment_nm, 'NOPART' AS partition_nm,
       'TABLE' AS segment_type, 0 AS head_block_cnt,
       ifnull(data_length + index_length, 0) AS segment_size, 0 AS block_cnt
FROM info_tables WHERE table_schema IN {_IN}""",
    )
    out["dic_segments_mssql"] = _check(
        _SEGMENT_COLUMNS,
        ("sys_tables", "sys_schemas", "partitions", "allocation_units"),
        mssql.segments,
        f"""
SELECT s.name AS owner_nm, t.name AS segment_nm, 'NOPART' AS partition_nm,
       'TABLE' AS segment_type, 0 AS head_block_cnt,
       CAST(ifnull((SELECT sum(u.total_pages) FROM partitions p, allocation_units u
                    WHERE u.container_id = p.partition_id AND p.object_id = t.object_id), 0) * 8192
            AS BIGINT) AS segment_size, 0 AS block_cnt
FROM sys_tables t JOIN sys_schemas s USING (schema_id) WHERE s.name IN {_IN}""",
    )
    out["dic_constraints_oracle"] = _check(
        _CONS_COLUMNS,
        ("all_constraints",),
        oracle.constraints,
        f"""
SELECT owner AS owner_nm, constraint_name AS cons_nm, constraint_type AS cons_type,
       table_name AS table_nm
FROM all_constraints
WHERE owner IN {_IN} AND constraint_type <> 'C' AND status <> 'DISABLED'
  AND left(table_name, 4) <> 'BIN$'""",
    )
    out["dic_constraints_ansi"] = _check(
        _CONS_COLUMNS,
        ("table_constraints",),
        ansi.constraints,
        f"""
SELECT table_schema AS owner_nm, constraint_name AS cons_nm, c.code AS cons_type,
       table_name AS table_nm
FROM table_constraints JOIN {_ANSI_CODES} ON c.kind = constraint_type
WHERE table_schema IN {_IN}""",
    )
    out["dic_cons_cols_oracle"] = _check(
        _CONS_COL_COLUMNS,
        ("all_cons_columns", "all_constraints"),
        oracle.constraint_columns,
        f"""
WITH live AS (SELECT * FROM all_constraints WHERE constraint_type <> 'C' AND status <> 'DISABLED')
SELECT owner AS owner_nm, constraint_name AS cons_nm, m.column_name AS col_nm,
       live.constraint_type AS cons_type, live.table_name AS table_nm,
       ifnull(m.position, 0) AS pos
FROM live JOIN all_cons_columns m USING (owner, constraint_name) WHERE owner IN {_IN}""",
    )
    out["dic_cons_cols_ansi"] = _check(
        _CONS_COL_COLUMNS,
        ("key_column_usage", "table_constraints"),
        ansi.constraint_columns,
        f"""
SELECT table_schema AS owner_nm, constraint_name AS cons_nm, k.column_name AS col_nm,
       c.code AS cons_type, table_name AS table_nm, k.ordinal_position AS pos
FROM table_constraints t
JOIN key_column_usage k USING (table_schema, table_name, constraint_name)
JOIN {_ANSI_CODES} ON c.kind = t.constraint_type
WHERE table_schema IN {_IN}""",
    )
    out["dic_indexes_oracle"] = _check(
        (*_INDEX_COLUMNS, "tablespace_nm"),
        ("all_indexes",),
        oracle.indexes,
        f"""
SELECT owner AS owner_nm, index_name AS index_nm, table_name AS tab_nm, index_type, uniqueness,
       if(partitioned = 'YES', 'Y', 'N') AS part_yn, status,
       tablespace_name AS tablespace_nm
FROM all_indexes WHERE owner IN {_IN}""",
    )
    # Straight from the given tables: one row per line, no join of a relation with itself.
    out["dic_indexes_postgres"] = Check(
        lambda frames: comparable(
            postgres.indexes(
                *extracts(frames, "pg_index", "pg_class", "pg_namespace", "pg_am", "pg_tablespace"),
                KEPT,
            ),
            *_INDEX_COLUMNS, "tablespace_nm",
        ),
        f"""
WITH line AS MATERIALIZED (
  SELECT l_orderkey, l_linenumber, max(l_linestatus) AS linestatus, min(l_discount) AS discount
  FROM lineitem GROUP BY l_orderkey, l_linenumber
)
SELECT o_orderpriority AS owner_nm, 'I' || o_orderkey || '_' || l_linenumber AS index_nm,
       'T' || o_orderkey AS tab_nm, r_name AS index_type,
       if(l_linenumber = 1, 'UNIQUE', 'NONUNIQUE') AS uniqueness, 'N' AS part_yn,
       if(discount > 0, 'VALID', 'UNUSABLE') AS status, n_name AS tablespace_nm
FROM line JOIN orders ON o_orderkey = l_orderkey
JOIN region ON r_regionkey = l_linenumber - 1
LEFT JOIN nation ON n_nationkey = if(linestatus = 'F', 99, CAST(left(o_orderpriority, 1) AS INTEGER))
WHERE o_orderpriority IN {_IN}""",
    )
    out["dic_indexes_mysql"] = _check(
        _INDEX_COLUMNS,
        ("statistics",),
        mysql.indexes,
        f"""
SELECT DISTINCT table_schema AS owner_nm, index_name AS index_nm, table_name AS tab_nm, index_type,
       if(non_unique = 0, 'UNIQUE', 'NONUNIQUE') AS uniqueness, 'N' AS part_yn, 'VALID' AS status
FROM statistics WHERE table_schema IN {_IN}""",
    )
    out["dic_indexes_mssql"] = _check(
        _INDEX_COLUMNS,
        ("sys_indexes", "sys_tables", "sys_schemas"),
        mssql.indexes,
        f"""
SELECT s.name AS owner_nm, i.name AS index_nm, t.name AS tab_nm, i.type_desc AS index_type,
       if(i.is_unique = 1, 'UNIQUE', 'NONUNIQUE') AS uniqueness, 'N' AS part_yn,
       if(i.is_disabled = 0, 'VALID', 'UNUSABLE') AS status
FROM sys_schemas s JOIN sys_tables t USING (schema_id) JOIN sys_indexes i USING (object_id)
WHERE i.name IS NOT NULL AND s.name IN {_IN}""",
    )
    out["dic_exclude_system_schemas"] = Check(
        lambda frames: comparable(
            drop_system_schemas(extract(frames, "all_indexes"), "owner", "oracle"),
            "owner", "index_name", "table_name",
        ),
        with_extracts(
            ("all_indexes",),
            """SELECT owner, index_name, table_name FROM all_indexes WHERE owner NOT IN
               ('SYS', 'SYSCAT', 'SYSGIS', 'SYSTEM', 'OUTLN', 'DBSNMP', 'APPQOSSYS', 'WMSYS', 'XDB')""",
        ),
    )
    out["dic_indexes_table_owner"] = Check(
        lambda frames: comparable(
            drop_system_schemas(
                oracle.index_owners(extract(frames, "all_indexes")), "owner_nm", "oracle"
            )
        ),
        with_extracts(
            ("all_indexes",),
            """SELECT owner AS owner_nm, index_name AS index_nm, table_owner AS tab_owner_nm,
                      table_name AS tab_nm FROM all_indexes WHERE owner <> 'SYS'""",
        ),
    )
    out["dic_indexes_table_owner_postgres"] = Check(
        lambda frames: comparable(
            drop_system_schemas(
                postgres.index_owners(extract(frames, "pg_indexes")), "owner_nm", "postgres"
            )
        ),
        with_extracts(
            ("pg_indexes",),
            """SELECT schemaname AS owner_nm, indexname AS index_nm, schemaname AS tab_owner_nm,
                      tablename AS tab_nm FROM pg_indexes""",
        ),
    )
    return out


def _snapshots() -> dict[str, Check]:
    def replaced(frames: Frames) -> DataFrame:
        """Load a snapshot, load another, load the first again with fewer rows."""
        store = scratch_store(frames)
        everything = oracle.tables(*extracts(frames, *_ORACLE_NAMES), KEPT)
        fewer = oracle.tables(*extracts(frames, *_ORACLE_NAMES), KEPT[:2])
        for chasu, rows in ((1, everything), (2, everything), (1, fewer)):
            store.replace_scope(
                "dic_tables",
                stamped(rows, DB, chasu, RUN_TS.date()),
                {"db_nm": DB, "chasu": chasu},
            )
        return comparable(
            store.read("dic_tables"), "chasu", "db_nm", "owner_nm", "tab_nm", "tab_mb_size"
        )

    def collected(frames: Frames) -> DataFrame:
        """Row counts of every dictionary part after one collection."""
        store = scratch_store(frames)
        with lines_at_hand(frames, *extract_names("oracle")) as joined:
            parts = oracle_parts(joined)
            chasu = collect_dictionary(frames.spark, store, DB, parts, RUN_TS)
        counts = [
            store.read(f"dic_{kind}")
            .filter(F.col("chasu") == chasu)
            .groupBy("db_nm", "chasu", "owner_nm")
            .agg(F.count(F.lit(1)).alias("row_cnt"))
            .withColumn("part", F.lit(kind))
            for kind in parts
        ]
        out = counts[0]
        for other in counts[1:]:
            out = out.unionByName(other)
        return out

    names = (
        "all_tables", "all_tab_columns", "all_views", "dba_segments", "all_constraints",
        "all_cons_columns", "all_indexes",
    )
    return {
        "snapshot_next_no": Check(
            lambda frames: snapshot.next_snapshot(extract(frames, "dic_snapshots"), DB),
            with_extracts(("dic_snapshots",), "SELECT max(chasu) + 1 AS chasu FROM dic_snapshots"),
        ),
        "snapshot_replace": Check(
            replaced,
            with_extracts(
                _ORACLE_NAMES,
                f"""
WITH latest AS ({_ORACLE_TABLES_SQL.strip()})
SELECT chasu, '{DB}' AS db_nm, owner_nm, tab_nm, tab_mb_size
FROM latest, (VALUES (1), (2)) AS load(chasu)
WHERE chasu = 2 OR owner_nm IN ('{KEPT[0]}', '{KEPT[1]}')""",
            ),
        ),
        "dic_collect_all": Check(
            collected,
            with_extracts(
                names,
                f"""
WITH live AS (SELECT * FROM all_constraints WHERE constraint_type <> 'C' AND status <> 'DISABLED'),
part_rows AS (
    SELECT 'tables' AS part, owner FROM all_tables
    UNION ALL SELECT 'columns', owner FROM all_tab_columns
        WHERE (owner, table_name) NOT IN (SELECT (owner, view_name) FROM all_views)
    UNION ALL SELECT 'segments', owner FROM dba_segments
        WHERE left(segment_name, 4) <> 'BIN$' AND segment_type <> 'LOBSEGMENT'
    UNION ALL SELECT 'constraints', owner FROM live WHERE left(table_name, 4) <> 'BIN$'
    UNION ALL SELECT 'constraint_columns', owner
        FROM all_cons_columns JOIN live USING (owner, constraint_name)
    UNION ALL SELECT 'indexes', owner FROM all_indexes
)
SELECT part, '{DB}' AS db_nm, 1 AS chasu, owner AS owner_nm, count(*) AS row_cnt
FROM part_rows WHERE owner IN {_IN} GROUP BY part, owner""",
            ),
        ),
    }


def _lake() -> dict[str, Check]:
    names = ", ".join(f"'{t}'" for t in SCHEMAS)
    as_spark = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPARK_TYPES.items())

    def files(frames: Frames) -> DataFrame:
        return lake.segments(frames.spark, frames.root)

    def lake_columns(frames: Frames) -> DataFrame:
        """Columns by the schemas in the files, with measured lengths and NULLs."""
        stored = {t: frames.spark.read.parquet(f"{frames.root}/{t}.parquet") for t in SCHEMAS}
        stats = column_stats(
            [profile_input(df, t) for t, df in stored.items()], with_row_count=True
        )
        return comparable(
            lake.measured(lake.columns(frames.spark, stored), stats),
            "owner_nm", "tab_nm", "col_nm", "col_seq", "data_type", "data_len", "null_yn",
        )

    def lake_tables(frames: Frames) -> DataFrame:
        return comparable(
            lake.tables(files(frames), row_counts(inputs(frames, *SCHEMAS))),
            "owner_nm", "tab_nm", "row_cnt", "part_yn",
        )

    def partitioned_segments(frames: Frames) -> DataFrame:
        """A lake of three formats, two of its tables partitioned by columns."""
        root = f"{shared_dir(frames.spark)}/lake-{uuid.uuid4().hex}"
        writes = {
            "orders": ("parquet", ["o_orderstatus", "o_orderpriority"]),
            "customer": ("csv", ["c_mktsegment"]),
            "nation": ("json", []),
        }
        for table, (fmt, by) in writes.items():
            frames[table].write.format(fmt).partitionBy(*by).save(f"{root}/{table}")
        found = lake.partition_segments(frames.spark, root)
        tables = lake.tables(found).select("owner_nm", F.col("tab_nm").alias("segment_nm"), "part_yn")
        return found.join(tables, ["owner_nm", "segment_nm"]).select(
            "owner_nm", "segment_nm", "partition_nm", "segment_type", "part_yn"
        )

    counts = " UNION ALL ".join(f"SELECT '{t}' AS tab_nm, count(*) AS n FROM {t}" for t in SCHEMAS)
    return {
        "dic_columns_spark": Check(
            lake_columns,
            f"""SELECT 'main' AS owner_nm, table_name AS tab_nm, column_name AS col_nm,
       ordinal_position AS col_seq, CASE data_type {as_spark} ELSE data_type END AS data_type,
       CAST(s.max_len AS BIGINT) AS data_len, if(s.notnull_cnt = c.n, 'N', 'Y') AS null_yn
FROM information_schema.columns i
LEFT JOIN ({sql.union(map(sql.stats, SCHEMAS))}) s
       ON s.tab_nm = i.table_name AND s.col_nm = i.column_name
LEFT JOIN ({counts}) c ON c.tab_nm = i.table_name
WHERE table_name IN ({names})""",
        ),
        "dic_segments_partitioned": Check(
            partitioned_segments,
            """SELECT DISTINCT 'main' AS owner_nm, 'orders' AS segment_nm,
       'o_orderstatus=' || o_orderstatus || '/o_orderpriority=' || o_orderpriority AS partition_nm,
       'TABLE PARTITION' AS segment_type, 'Y' AS part_yn
FROM orders
UNION ALL SELECT DISTINCT 'main', 'customer', 'c_mktsegment=' || c_mktsegment, 'TABLE PARTITION', 'Y'
FROM customer
UNION ALL SELECT 'main', 'nation', 'NOPART', 'TABLE', 'N'""",
        ),
        "dic_tables_spark": Check(
            lake_tables,
            f"SELECT 'main' AS owner_nm, tab_nm, n AS row_cnt, 'N' AS part_yn FROM ({counts})",
        ),
    }


def _legacy() -> dict[str, Check]:
    table_names = ("all_tables", "all_tab_comments", "dba_segments", "dba_objects")
    column_names = (
        "all_tab_columns", "all_col_comments", "all_constraints", "all_cons_columns", "all_views",
    )

    def lists(frames: Frames):
        return (
            legacy.schema_list(extract(frames, "all_users"), 7),
            legacy.table_list(*extracts(frames, *table_names), 7),
            legacy.column_list(*extracts(frames, *column_names), 7),
        )

    return {
        "legacy_schema_list": Check(
            lambda frames: lists(frames)[0],
            with_extracts(
                ("all_users",),
                """SELECT 7 AS "DB번호", username AS "스키마명" FROM all_users WHERE username <> 'SYS'""",
            ),
        ),
        "legacy_table_list": Check(
            lambda frames: comparable(lists(frames)[1]),
            with_extracts(
                table_names,
                f"""
SELECT 7 AS "DB번호", t.owner AS "스키마명", t.table_name AS "테이블명",
       ifnull(m.comments, '') AS "테이블코멘트",
       ifnull((SELECT sum(bytes)::DOUBLE FROM dba_segments s
               WHERE s.owner = t.owner AND s.segment_name = t.table_name), 0) / 1048576
           AS "테이블사이즈",
       (SELECT {sql_stamp('min(created)')} FROM dba_objects b
        WHERE b.owner = t.owner AND b.object_name = t.table_name AND object_type ^@ 'TABLE')
           AS "테이블최초생성일시"
FROM all_tables t JOIN all_tab_comments m USING (owner, table_name) WHERE t.owner <> 'SYS'""",
            ),
        ),
        "legacy_column_list": Check(
            lambda frames: lists(frames)[2],
            with_extracts(
                column_names,
                """
WITH pk AS (
    SELECT k.owner, k.table_name, m.column_name
    FROM all_constraints k JOIN all_cons_columns m USING (owner, table_name, constraint_name)
    WHERE k.constraint_type = 'P'
)
SELECT 7 AS "DB번호", c.owner AS "스키마명", c.table_name AS "테이블명", c.column_name AS "컬럼명",
       ifnull(m.comments, '') AS "컬럼코멘트", c.data_type AS "데이터타입",
       c.column_id AS "컬럼순서", c.nullable AS "NULL여부",
       if(pk.column_name IS NULL, '', 'Y') AS "PK여부",
       if(c.data_precision > 0, c.data_precision, c.data_length) AS "길이",
       ifnull(c.data_scale, 0) AS "소수점"
FROM all_tab_columns c
JOIN all_col_comments m USING (owner, table_name, column_name)
LEFT JOIN pk ON (pk.owner, pk.table_name, pk.column_name) = (c.owner, c.table_name, c.column_name)
WHERE c.owner <> 'SYS'
  AND (c.owner, c.table_name) NOT IN (SELECT (owner, view_name) FROM all_views)""",
            ),
        ),
        "snapshot_exists_check": Check(
            lambda frames: legacy.rows_exist(*lists(frames), 7),
            with_extracts(
                ("all_users", *table_names, *column_names),
                """
SELECT CAST(
    (SELECT count(*) > 0 FROM all_users WHERE username <> 'SYS')::INT
    + (SELECT count(*) > 0 FROM all_tables JOIN all_tab_comments USING (owner, table_name)
       WHERE owner <> 'SYS')::INT
    + (SELECT count(*) > 0 FROM all_tab_columns JOIN all_col_comments USING (owner, table_name, column_name)
       WHERE owner <> 'SYS' AND (owner, table_name) NOT IN (SELECT (owner, view_name) FROM all_views))::INT
    AS BIGINT) AS cnt""",
            ),
        ),
    }


def checks() -> dict[str, Check]:
    return _normalisers() | _snapshots() | _lake() | _legacy()
