"""Vendor normalisers on small catalogs with hand-computed results."""

import datetime as dt
import re
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabscope.operators.dictionary import ansi, lake, legacy, mssql, mysql, oracle, postgres, snapshot
from tabscope.operators.dictionary.common import drop_system_schemas, keep_schemas, shaped, stamped
from tabscope.operators.registration import primary_key_positions

MB = 1024 * 1024
TS = dt.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture(scope="module")
def ora(spark):
    make = spark.createDataFrame
    return {
        "tables": make(
            [("A", "T", "USERS", 5, TS, "NO"), ("A", "P", None, 7, None, "YES"),
             ("A", "NOSEG", "USERS", None, None, "NO"), ("X", "OUT", "USERS", 1, TS, "NO")],
            "owner string, table_name string, tablespace_name string, num_rows bigint, "
            "last_analyzed timestamp_ntz, partitioned string",
        ),
        "comments": make(
            [("A", "T", "TABLE", "a table"), ("A", "P", "TABLE", None), ("A", "P", "VIEW", "no")],
            "owner string, table_name string, table_type string, comments string",
        ),
        "segments": make(
            [("A", "T", None, "TABLE", "USERS", 3 * MB - 1), ("A", "P", "P1", "TABLE PARTITION", "U1", 1024 * MB),
             ("A", "P", "P2", "TABLE PARTITION", "U2", 2 * MB), ("A", "PK_T", None, "INDEX", "USERS", 9 * MB),
             ("A", "BIN$X", None, "TABLE", "USERS", MB), ("A", "BINARY", None, "TABLE", "USERS", None),
             ("A", "L", None, "LOBSEGMENT", "USERS", MB), ("X", "OUT", None, "TABLE", "USERS", MB)],
            "owner string, segment_name string, partition_name string, segment_type string, "
            "tablespace_name string, bytes bigint",
        ),
        "columns": make(
            [("A", "T", "ID", 1, "NUMBER", 22, "N", 10, 0, None), ("A", "T", "NM", 2, "VARCHAR2", 30, "Y", None, None, "'x'"),
             ("A", "V", "ID", 1, "NUMBER", 22, "Y", None, None, None), ("X", "OUT", "ID", 1, "NUMBER", 22, "N", None, None, None)],
            "owner string, table_name string, column_name string, column_id int, data_type string, "
            "data_length int, nullable string, data_precision int, data_scale int, data_default string",
        ),
        "col_comments": make(
            [("A", "T", "ID", "key"), ("A", "T", "NM", None)],
            "owner string, table_name string, column_name string, comments string",
        ),
        "views": make([("A", "V")], "owner string, view_name string"),
        "constraints": make(
            [("A", "T", "PK_T", "P", "ENABLED"), ("A", "T", "FK_T", "R", "ENABLED"), ("A", "T", "U_T", "U", "DISABLED"),
             ("A", "T", "C_T", "C", "ENABLED"), ("A", "BIN$X", "PK_X", "P", "ENABLED"), ("X", "OUT", "PK_O", "P", "ENABLED")],
            "owner string, table_name string, constraint_name string, constraint_type string, status string",
        ),
        "cons_columns": make(
            [("A", "T", "PK_T", "ID", 1), ("A", "T", "PK_T", "NM", 2), ("A", "T", "FK_T", "NM", None), ("A", "T", "U_T", "NM", 1)],
            "owner string, table_name string, constraint_name string, column_name string, position int",
        ),
    }


def test_oracle_tables(ora, rows):
    got = rows(
        oracle.tables(ora["tables"], ora["comments"], ora["segments"], ["A"]),
        "tab_nm", "tab_comment", "part_yn", "tab_mb_size", "tab_gb_size", "row_cnt",
    )
    assert got == sorted(
        [("T", "a table", "N", Decimal("2.00"), Decimal("0.0000"), 5),
         ("P", "", "Y", Decimal("1026.00"), Decimal("1.0000"), 7),
         ("NOSEG", "", "N", Decimal("0.00"), Decimal("0.0000"), None)], key=repr)


def test_oracle_columns(ora, rows):
    got = rows(
        oracle.columns(ora["columns"], ora["col_comments"], ora["views"], ["A"]),
        "tab_nm", "col_nm", "col_comment", "col_seq", "def_value",
    )
    assert got == [("T", "ID", "key", 1, None), ("T", "NM", "", 2, "'x'")]


def test_oracle_segments(ora, rows):
    got = rows(oracle.segments(ora["segments"], ["A"]), "segment_nm", "partition_nm", "segment_size")
    assert got == [("BINARY", "NOPART", 0), ("P", "P1", 1024 * MB), ("P", "P2", 2 * MB),
                   ("PK_T", "NOPART", 9 * MB), ("T", "NOPART", 3 * MB - 1)]


def test_oracle_constraints(ora, rows):
    assert rows(oracle.constraints(ora["constraints"], ["A"]), "cons_nm", "cons_type", "table_nm", "index_nm") == [
        ("FK_T", "R", "T", None), ("PK_T", "P", "T", None)]
    assert rows(oracle.constraint_columns(ora["cons_columns"], ora["constraints"], ["A"]), "cons_nm", "col_nm", "cons_type", "pos") == [
        ("FK_T", "NM", "R", 0), ("PK_T", "ID", "P", 1), ("PK_T", "NM", "P", 2)]


def test_indexes_keep_status_and_tablespace(spark, rows):
    extract = spark.createDataFrame(
        [("A", "PK_T", "T", "NORMAL", "UNIQUE", "YES", "VALID", "USERS")],
        "owner string, index_name string, table_name string, index_type string, uniqueness string, "
        "partitioned string, status string, tablespace_name string",
    )
    assert rows(oracle.indexes(extract, ["A"]), "index_nm", "part_yn", "status", "tablespace_nm") == [("PK_T", "Y", "VALID", "USERS")]


def test_schema_lists(ora):
    assert keep_schemas(ora["tables"], "owner", []).isEmpty()
    assert drop_system_schemas(ora["tables"], "owner", "oracle", ["A"]).count() == 1
    with pytest.raises(KeyError):
        drop_system_schemas(ora["tables"], "owner", "db2")
    with pytest.raises(ValueError):
        shaped(ora["tables"], "tables", nope=F.lit(1))


def test_stamp(ora):
    row = stamped(oracle.segments(ora["segments"], ["X"]), "db", 3, TS.date()).first()
    assert (row.chasu, row.db_nm, row.cr_dt) == (3, "db", TS.date())


@pytest.fixture(scope="module")
def pg(spark):
    make = spark.createDataFrame
    return {
        "tables": make([("s", "t", "BASE TABLE"), ("s", "v", "VIEW"), ("s", "bare", "BASE TABLE"), ("z", "t", "BASE TABLE")],
                       "table_schema string, table_name string, table_type string"),
        "class": make([(10, "t", 1, "r", 0, 0, 8192, 3 * MB), (11, "t_pk", 1, "i", 7, 403, 100, 100), (12, "t", 2, "r", 7, 0, 5, 9 * MB),
                       (13, "sq", 1, "S", 0, 0, 1, 1), (14, "p", 1, "p", 0, 0, 2, 2), (15, "pi", 1, "I", 0, 403, 3, 3)],
                      "oid bigint, relname string, relnamespace bigint, relkind string, reltablespace bigint, relam bigint, size_bytes bigint, total_bytes bigint"),
        "ns": make([(1, "s"), (2, "z")], "oid bigint, nspname string"),
        "space": make([(7, "fast")], "oid bigint, spcname string"),
        "stat": make([("s", "t", 10, 42, TS)], "schemaname string, relname string, relid bigint, n_live_tup bigint, last_analyze timestamp_ntz"),
        "descr": make([(10, "pg_class", 0, "table"), (10, "pg_proc", 0, "function of the same oid"), (10, "pg_class", 2, "second")],
                      "objoid bigint, classname string, objsubid int, description string"),
    }


def test_postgres_tables(pg, rows):
    got = rows(postgres.tables(pg["tables"], pg["class"], pg["ns"], pg["space"], pg["stat"], pg["descr"], ["s"]),
               "tab_nm", "tab_comment", "tablespace_nm", "row_cnt", "tab_mb_size")
    assert got == [("bare", "", None, None, Decimal("0.00")), ("t", "table", None, 42, Decimal("3.00"))]


def test_postgres_columns(spark, pg, rows):
    columns = spark.createDataFrame(
        [("s", "t", "a", 1, "integer", None, 32, 0, None, "NO", None), ("s", "t", "b", 2, "varchar", 20, None, None, None, "YES", "x"),
         ("s", "t", "c", 3, "timestamp", None, None, None, 6, "YES", None), ("s", "v", "a", 1, "integer", None, 32, 0, None, "NO", None)],
        "table_schema string, table_name string, column_name string, ordinal_position int, data_type string, character_maximum_length int, "
        "numeric_precision int, numeric_scale int, datetime_precision int, is_nullable string, column_default string")
    views = spark.createDataFrame([("s", "v")], "table_schema string, table_name string")
    got = rows(postgres.columns(columns, views, pg["stat"], pg["descr"], ["s"]), "col_nm", "col_comment", "data_len", "null_yn")
    assert got == [("a", "", 32, "N"), ("b", "second", 20, "Y"), ("c", "", 6, "Y")]
    commented = columns.withColumn("column_comment", F.lit(None).cast("string"))
    assert rows(mysql.columns(commented, views, ["s"]), "col_nm", "col_comment") == [("a", ""), ("b", ""), ("c", "")]


def test_postgres_segments_and_indexes(spark, pg, rows):
    assert rows(postgres.segments(pg["class"], pg["ns"], ["s"]), "segment_nm", "segment_type", "segment_size") == [
        ("p", "TABLE PARTITION", 2), ("pi", "INDEX PARTITION", 3), ("t", "TABLE", 8192), ("t_pk", "INDEX", 100)]
    index = spark.createDataFrame([(11, 10, True, False)], "indexrelid bigint, indrelid bigint, indisunique boolean, indisvalid boolean")
    am = spark.createDataFrame([(403, "btree")], "oid bigint, amname string")
    assert rows(postgres.indexes(index, pg["class"], pg["ns"], am, pg["space"], ["s"]),
                "owner_nm", "index_nm", "tab_nm", "index_type", "uniqueness", "status", "tablespace_nm") == [
        ("s", "t_pk", "t", "btree", "UNIQUE", "UNUSABLE", "fast")]


def test_mysql_tables_segments_indexes(spark, rows):
    tables = spark.createDataFrame(
        [("s", "t", "BASE TABLE", None, 4, TS, 1024 * MB, 5 * 1024), ("s", "v", "VIEW", "", None, None, None, None)],
        "table_schema string, table_name string, table_type string, table_comment string, table_rows bigint, update_time timestamp_ntz, data_length bigint, index_length bigint")
    assert rows(mysql.tables(tables, ["s"]), "tab_nm", "tab_comment", "tab_mb_size", "tab_gb_size") == [("t", "", Decimal("1024.00"), Decimal("1.0000"))]
    assert rows(mysql.segments(tables, ["s"]), "segment_nm", "segment_type", "segment_size") == [("t", "TABLE", 1024 * MB + 5 * 1024), ("v", "TABLE", 0)]
    statistics = spark.createDataFrame(
        [("s", "t", "PRIMARY", "BTREE", 0, "a"), ("s", "t", "PRIMARY", "BTREE", 0, "b"), ("s", "t", "ix", "BTREE", 1, "b")],
        "table_schema string, table_name string, index_name string, index_type string, non_unique int, column_name string")
    assert rows(mysql.indexes(statistics, ["s"]), "index_nm", "uniqueness") == [("PRIMARY", "UNIQUE"), ("ix", "NONUNIQUE")]


def test_ansi_constraints(spark, rows):
    constraints = spark.createDataFrame(
        [("s", "t", "pk", "PRIMARY KEY"), ("s", "t", "fk", "FOREIGN KEY"), ("s", "t", "u", "UNIQUE"), ("s", "t", "ck", "CHECK"), ("z", "t", "pk", "PRIMARY KEY")],
        "table_schema string, table_name string, constraint_name string, constraint_type string")
    usage = spark.createDataFrame([("s", "t", "pk", "a", 1), ("s", "t", "pk", "b", 2), ("s", "t", "ck", "a", 1), ("z", "t", "pk", "a", 1)],
                                  "table_schema string, table_name string, constraint_name string, column_name string, ordinal_position int")
    assert rows(ansi.constraints(constraints, ["s"]), "cons_nm", "cons_type") == [("fk", "R"), ("pk", "P"), ("u", "U")]
    assert rows(ansi.constraint_columns(usage, constraints, ["s"]), "cons_nm", "col_nm", "cons_type", "pos") == [("pk", "a", "P", 1), ("pk", "b", "P", 2)]


def test_tables_may_share_constraint_names(spark):
    """MySQL names every primary key PRIMARY: 200 tables have 200 key columns."""
    constraints = spark.range(200).selectExpr(
        "'s' AS table_schema", "concat('t', id) AS table_name", "'PRIMARY' AS constraint_name", "'PRIMARY KEY' AS constraint_type")
    usage = constraints.selectExpr("table_schema", "table_name", "constraint_name", "'id' AS column_name", "1 AS ordinal_position")
    members = ansi.constraint_columns(usage, constraints, ["s"])
    assert members.count() == 200
    columns = members.selectExpr("owner_nm", "table_nm AS tab_nm", "col_nm")
    placed = primary_key_positions(columns, ansi.constraints(constraints, ["s"]), members)
    assert placed.count() == 200 and placed.filter("pk_col_seq = 1").count() == 200


@pytest.fixture(scope="module")
def ms(spark):
    make = spark.createDataFrame
    return {
        "tables": make([(1, 5, "t"), (2, 6, "out")], "object_id bigint, schema_id int, name string"),
        "schemas": make([(5, "dbo"), (6, "x")], "schema_id int, name string"),
        "props": make([(1, 0, "MS_Description", "table"), (1, 2, "MS_Description", "col"), (1, 1, "Other", "no")],
                      "major_id bigint, minor_id int, name string, value string"),
        "partitions": make([(1, 1, 100, 10), (1, 0, 101, 5), (1, 2, 102, 99)], "object_id bigint, index_id int, partition_id bigint, rows bigint"),
        "units": make([(100, 64), (100, 64), (102, 999)], "container_id bigint, total_pages bigint"),
    }


def test_mssql_rows_count_once_per_unit_by_default(ms, rows):
    args = (ms["tables"], ms["schemas"], ms["props"], ms["partitions"], ms["units"], ["dbo"])
    picked = ("tab_nm", "tab_comment", "row_cnt", "tab_mb_size")
    assert rows(mssql.tables(*args), *picked) == [("t", "table", 25, Decimal("1.00"))]
    assert rows(mssql.tables(*args, rows_per_unit=False), *picked) == [("t", "table", 15, Decimal("1.00"))]


def test_mssql_columns_and_indexes(spark, ms, rows):
    columns = spark.createDataFrame([(1, 1, "a", 56, 4, 10, 0, 0), (1, 2, "b", 56, None, 9, 2, 1), (1, 3, "c", 99, 4, 1, 0, 0)],
                                    "object_id bigint, column_id int, name string, user_type_id int, max_length int, precision int, scale int, is_nullable int")
    types = spark.createDataFrame([(56, "int")], "user_type_id int, name string")
    defaults = spark.createDataFrame([(1, 2, "((0))")], "parent_object_id bigint, parent_column_id int, definition string")
    assert rows(mssql.columns(columns, ms["tables"], ms["schemas"], types, ms["props"], defaults, ["dbo"]),
                "col_nm", "col_comment", "data_len", "null_yn", "def_value") == [("a", "", 4, "N", None), ("b", "col", 9, "Y", "((0))")]
    indexes = spark.createDataFrame([(1, "pk", "CLUSTERED", 1, 0), (1, None, "HEAP", 0, 0), (1, "ix", "NONCLUSTERED", 0, 1)],
                                    "object_id bigint, name string, type_desc string, is_unique int, is_disabled int")
    assert rows(mssql.indexes(indexes, ms["tables"], ms["schemas"], ["dbo"]), "index_nm", "uniqueness", "status") == [
        ("ix", "NONUNIQUE", "UNUSABLE"), ("pk", "UNIQUE", "VALID")]


def test_legacy_lists(spark, ora, rows):
    users = spark.createDataFrame([("A",), ("SYS",), ("OUTLN",)], "username string")
    assert rows(legacy.schema_list(users, 3)) == [(3, "A")]
    objects = spark.createDataFrame([("A", "T", "TABLE", TS), ("A", "T", "INDEX", dt.datetime(2000, 1, 1))], "owner string, object_name string, object_type string, created timestamp_ntz")
    comments = ora["comments"].filter("table_type = 'TABLE'")
    assert rows(legacy.table_list(ora["tables"], comments, ora["segments"], objects, 3), "테이블명", "테이블코멘트", "테이블사이즈", "테이블최초생성일시") == [
        ("P", "", 1026.0, None), ("T", "a table", (3 * MB - 1) / MB, TS)]
    columns = legacy.column_list(ora["columns"], ora["col_comments"], ora["constraints"], ora["cons_columns"], ora["views"], 3)
    assert rows(columns, "컬럼명", "컬럼코멘트", "PK여부", "길이", "소수점") == [("ID", "key", "Y", 10, 0), ("NM", "", "Y", 30, 0)]
    assert [r[0] for r in legacy.repository_columns(columns).select("소수점").collect()] == [None, None]


def test_snapshot_numbers(spark):
    master = spark.createDataFrame([(1, "a"), (2, "a"), (9, "b")], "chasu int, db_nm string")
    assert snapshot.latest_snapshot(master, "a").first()[0] == 2
    assert snapshot.next_snapshot(master, "a").first()[0] == 3
    assert snapshot.next_snapshot(master, "new").first()[0] == 1
    assert snapshot.require_snapshot(master, "b") == 9
    with pytest.raises(ValueError):
        snapshot.require_snapshot(master, "new")


def test_lake_dictionary(spark, tmp_path, rows):
    root = str(tmp_path / "lake")
    spark.range(10).select("id", (F.col("id") % 2).alias("part")).write.partitionBy("part").parquet(f"{root}/events.parquet")
    (tmp_path / "lake" / "single.parquet").write_bytes(b"x" * 7)
    segments = lake.segments(spark, root)
    got = rows(segments, "segment_nm", "segment_type")
    assert ("single", "TABLE") in got and set(got) == {("single", "TABLE"), ("events", "TABLE PARTITION")}
    parts = {r[0].split("/")[0] for r in rows(segments.filter("segment_nm = 'events'"), "partition_nm")}
    assert parts == {"part=0", "part=1"}
    assert rows(lake.tables(segments), "tab_nm", "part_yn") == [("events", "Y"), ("single", "N")]
    frame = spark.createDataFrame([(1, Decimal("1.5"))], "a int, b decimal(10,2)")
    assert rows(lake.columns(spark, {"t": frame}), "col_nm", "col_seq", "data_type", "data_precision", "data_scale") == [
        ("a", 1, "int", None, None), ("b", 2, "decimal(10,2)", 10, 2)]
    assert lake.empty(spark, "indexes").isEmpty()
    stats = spark.createDataFrame([("main", "t", "a", 3, 1, 2)], "owner_nm string, tab_nm string, col_nm string, max_len int, notnull_cnt bigint, tab_cnt bigint")
    seen = lake.measured(lake.columns(spark, {"t": frame}), stats)
    assert rows(seen, "col_nm", "data_len", "null_yn") == [("a", 3, "Y"), ("b", None, "Y")]


def test_objects_meet_their_schemas_without_moving(spark):
    """Objects of a schema are not gathered in one task to learn its name."""
    ids = spark.range(1000)
    schemas = ids.selectExpr("id % 3 AS schema_id", "concat('S', id % 3) AS name").distinct()
    tables = ids.selectExpr("id AS object_id", "id % 3 AS schema_id", "concat('T', id) AS name")
    indexes = ids.selectExpr(
        "id AS object_id", "concat('I', id) AS name", "'HEAP' AS type_desc", "0 AS is_unique",
        "0 AS is_disabled",
    )
    made = mssql.indexes(indexes, tables, schemas, ["S0", "S1"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert made.count() == 667


def test_segments_are_summed_once(spark):
    """Pages are joined and summed per table, with no aggregate of the units before."""
    parts = spark.createDataFrame([(1, 11), (1, 12), (2, 21), (3, 31)], "object_id long, partition_id long")
    units = spark.createDataFrame(
        [(11, 1), (11, 2), (12, None), (21, None), (99, 7)], "container_id long, total_pages long"
    )
    tables = spark.createDataFrame([(i, 1, f"T{i}") for i in (1, 2, 3)], "object_id long, schema_id long, name string")
    schemas = spark.createDataFrame([(1, "S")], "schema_id long, name string")
    made = mssql.segments(tables, schemas, parts, units, ["S"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert {(r.segment_nm, r.segment_size) for r in made.collect()} == {("T1", 24576), ("T2", 0), ("T3", 0)}


def test_relations_no_table_is_named_like_go_before_they_are_described(spark):
    make = spark.createDataFrame
    base = make([("S", "T1", "BASE TABLE"), ("S", "T2", "BASE TABLE"), ("X", "T1", "BASE TABLE")],
                "table_schema string, table_name string, table_type string")
    classes = make([(10, "T1", 1, 0, 5 * MB), (11, "I1", 1, 0, MB), (12, "T1", 2, 0, MB)],
                   "oid long, relname string, relnamespace long, reltablespace long, total_bytes long")
    spaces, stats = make([(0, "SP")], "oid long, spcname string"), make(
        [("S", "T2", 7, TS)], "schemaname string, relname string, n_live_tup long, last_analyze timestamp_ntz")
    comments = make([(10, "pg_class", 0, "one"), (11, "pg_class", 0, "index")],
                    "objoid long, classname string, objsubid int, description string")
    names = make([(1, "S"), (2, "X")], "oid long, nspname string")
    made = postgres.tables(base, classes, names, spaces, stats, comments, ["S"])
    assert "LeftSemi" in made._jdf.queryExecution().optimizedPlan().toString()
    found = {(r.tab_nm, r.tab_comment, r.tablespace_nm, r.row_cnt, r.tab_mb_size) for r in made.collect()}
    assert found == {("T1", "one", "SP", None, 5), ("T2", "", None, 7, 0)}


def test_lines_are_dealt_over_more_tasks_as_they_grow(small, monkeypatch):
    """What one task joins and groups of an extract is bounded by bytes, not by settings."""
    from verification import catalogs

    before = {tuple(r) for r in catalogs.extract(small, "sys_indexes").collect()}
    size = small.bytes("lineitem") + small.bytes("orders")
    assert size > 0
    monkeypatch.setattr(catalogs, "TASK_BYTES", size // 20)
    dealt = catalogs.extract(small, "sys_indexes")
    assert dealt.rdd.getNumPartitions() >= 20
    assert {tuple(r) for r in dealt.collect()} == before


@pytest.fixture
def odd_lines(spark, tmp_path):
    """Orders and lines with NULLs, keys that come twice, and lines that come twice."""
    from verification.tables import SCHEMAS, SPARK_TYPES, Frames

    def write(table, data):
        ddl = ", ".join(f"{c} {SPARK_TYPES[t]}" for c, t in SCHEMAS[table].items())
        spark.createDataFrame(data, ddl).repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")

    orders = [
        (k, k % 5, ("F", "O", "P", None)[k % 4], 40_000.0 * k, TS, ("1-URGENT", "2-HIGH", "5-LOW", None)[k % 3])
        for k in range(12)
    ]
    write("orders", [*orders, (3, 9, "F", 1.0, TS, "2-HIGH"), orders[4], (None, 1, "F", 2.0, TS, "1-URGENT")])
    lines = [
        (k, k * 7, 1, n, float(n + k % 2), 1000.5 * k, 0.01 * (k % 4), 0.02 * n, "ANR"[(k + n) % 3], "FO"[n % 2], TS)
        for k in range(12) for n in range(1, 5)
    ]
    twice = [(*line[:4], 9.0, None, None, None, None, "O", TS) for line in lines[::5]]
    write("lineitem", [*lines, *lines[::3], *twice, (None, *lines[0][1:]), (5, None, None, None, *lines[0][4:])])
    return Frames(spark, str(tmp_path))


def test_extracts_share_lines_joined_and_grouped_once(odd_lines, rows):
    from verification import catalogs

    names = [*catalogs.ORACLE, *catalogs.DICTIONARY]
    before = {name: rows(catalogs.extract(odd_lines, name)) for name in names}
    tables = odd_lines.spark.catalog.listTables
    views = len(tables())
    with catalogs.lines_at_hand(odd_lines, *names) as joined:
        for name in names:
            made = catalogs.extract(joined, name)
            assert rows(made) == before[name], name
            if "{lineitem}" in catalogs.EXTRACTS[name] and name != "old_columns":
                text = made._jdf.queryExecution().executedPlan().toString()
                above = text.split("InMemoryRelation")[0]
                assert not re.search("Exchange|Join|Aggregate|Sort|FileScan", above), name
    assert len(tables()) == views and odd_lines.lines is None


def test_parts_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    from tabscope.pipeline import collect_dictionary
    from tabscope.sources.store import ResultStore

    store, both, load = ResultStore(spark, str(tmp_path)), threading.Barrier(2), ResultStore.replace_scope

    def meet(self, table, *given):
        if table in ("dic_tables", "dic_columns"):
            both.wait(60)
        load(self, table, *given)

    monkeypatch.setattr(ResultStore, "replace_scope", meet)
    kinds = ("tables", "columns", "indexes")
    assert collect_dictionary(spark, store, "db", {k: lake.empty(spark, k) for k in kinds}, TS) == 1
    assert store.read("dic_snapshots").count() == 1
