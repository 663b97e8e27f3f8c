"""Statements that a source runs itself, and jobs that mix them with files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabscope.operators import remote
from tabscope.operators.column_stats import column_stats
from tabscope.operators.dictionary import lake
from tabscope.operators.remote import RemoteInput, RemoteTable
from tabscope.operators.value_dist import value_histogram
from tabscope.pipeline import Profiler, collect_dictionary, register_population
from tabscope.plans.spec import ColumnSpec, ProfileInput, TableSpec, spec_from_schema
from tabscope.sources import jdbc, statements
from tabscope.sources.registry import SourceRegistry
from tabscope.sources.store import ResultStore
from verification.inputs import remote_input

ID = ColumnSpec("ID", "B", vendor_type="NUMBER")
NAME = ColumnSpec("NAME", "Y", vendor_type="VARCHAR2")
DAY = ColumnSpec("DAY", "A", vendor_type="DATE")


def test_counts():
    assert statements.count_statement("oracle", ("S", "T")) == 'SELECT COUNT(*) AS tab_cnt FROM "S"."T"'
    assert statements.count_statement("mssql", ("s", "t")) == "SELECT COUNT_BIG(*) AS tab_cnt FROM [s].[t]"


# Hand-written: one numeric and one text column.
STATS = {
    "oracle": 'SELECT COUNT("ID") AS n0, COUNT(DISTINCT "ID") AS k0, MAX(TO_CHAR("ID")) AS h0,'
    ' MIN(TO_CHAR("ID")) AS l0, MAX(LENGTH(TO_CHAR("ID"))) AS m0, COUNT("NAME") AS n1,'
    ' COUNT(DISTINCT TO_CHAR("NAME")) AS k1, MAX(TO_CHAR("NAME")) AS h1, MIN(TO_CHAR("NAME")) AS l1,'
    ' MAX(LENGTH(TO_CHAR("NAME"))) AS m1 FROM "S"."T"',
    "postgres": 'SELECT COUNT("ID") AS n0, COUNT(DISTINCT "ID") AS k0,'
    ' MAX(CAST("ID" AS TEXT) COLLATE "C") AS h0, MIN(CAST("ID" AS TEXT) COLLATE "C") AS l0,'
    ' MAX(CHAR_LENGTH(CAST("ID" AS TEXT) COLLATE "C")) AS m0, COUNT("NAME") AS n1,'
    ' COUNT(DISTINCT CAST("NAME" AS TEXT) COLLATE "C") AS k1,'
    ' MAX(CAST("NAME" AS TEXT) COLLATE "C") AS h1, MIN(CAST("NAME" AS TEXT) COLLATE "C") AS l1,'
    ' MAX(CHAR_LENGTH(CAST("NAME" AS TEXT) COLLATE "C")) AS m1 FROM "S"."T"',
    "mssql": "SELECT COUNT_BIG([ID]) AS n0, COUNT_BIG(DISTINCT [ID]) AS k0,"
    " MAX(CONVERT(NVARCHAR(MAX), [ID]) COLLATE Latin1_General_BIN2) AS h0,"
    " MIN(CONVERT(NVARCHAR(MAX), [ID]) COLLATE Latin1_General_BIN2) AS l0,"
    " MAX(LEN(CONVERT(NVARCHAR(MAX), [ID]) COLLATE Latin1_General_BIN2 + N'.') - 1) AS m0,"
    " COUNT_BIG([NAME]) AS n1,"
    " COUNT_BIG(DISTINCT CONVERT(NVARCHAR(MAX), [NAME]) COLLATE Latin1_General_BIN2) AS k1,"
    " MAX(CONVERT(NVARCHAR(MAX), [NAME]) COLLATE Latin1_General_BIN2) AS h1,"
    " MIN(CONVERT(NVARCHAR(MAX), [NAME]) COLLATE Latin1_General_BIN2) AS l1,"
    " MAX(LEN(CONVERT(NVARCHAR(MAX), [NAME]) COLLATE Latin1_General_BIN2 + N'.') - 1) AS m1"
    " FROM [S].[T]",
    "mysql": "SELECT COUNT(`ID`) AS n0, COUNT(DISTINCT `ID`) AS k0,"
    " MAX(CAST(`ID` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin) AS h0,"
    " MIN(CAST(`ID` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin) AS l0,"
    " MAX(CHAR_LENGTH(CAST(`ID` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin)) AS m0,"
    " COUNT(`NAME`) AS n1,"
    " COUNT(DISTINCT CAST(`NAME` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin) AS k1,"
    " MAX(CAST(`NAME` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin) AS h1,"
    " MIN(CAST(`NAME` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin) AS l1,"
    " MAX(CHAR_LENGTH(CAST(`NAME` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin)) AS m1"
    " FROM `S`.`T`",
}


@pytest.mark.parametrize("vendor", sorted(STATS))
def test_statistics(vendor):
    assert statements.stats_statement(vendor, ("S", "T"), [ID, NAME]) == STATS[vendor]


ORACLE_RANGES = (
    """CASE WHEN "ID" IS NULL THEN '##' WHEN "ID" = 0 THEN '0' WHEN "ID" BETWEEN 1 AND 100 THEN '1~100'"""
    """ WHEN "ID" BETWEEN 101 AND 1000 THEN '101~1000' WHEN "ID" BETWEEN 1001 AND 10000 THEN '1001~10000'"""
    """ WHEN "ID" BETWEEN 10001 AND 100000 THEN '10001~100000' WHEN "ID" BETWEEN 100001 AND 1000000 THEN"""
    """ '100001~1000000' WHEN "ID" < 0 THEN '0미만' ELSE '1000000초과' END"""
)

HISTOGRAMS = {
    "oracle": "SELECT CASE WHEN GROUPING(b0) = 0 THEN 0 WHEN GROUPING(b1) = 0 THEN 1 WHEN GROUPING(b2) = 0 THEN 2 END AS col_no,"
    " CASE WHEN GROUPING(b0) = 0 THEN b0 WHEN GROUPING(b1) = 0 THEN b1 WHEN GROUPING(b2) = 0 THEN b2 END AS col_val,"
    f" COUNT(*) AS col_val_cnt FROM (SELECT {ORACLE_RANGES} AS b0,"
    """ SUBSTR(COALESCE(TO_CHAR("NAME"), '##'), 1, 100) AS b1, COALESCE(TO_CHAR("DAY", 'YYYYMM'), '##') AS b2"""
    ' FROM "S"."T") s GROUP BY GROUPING SETS ((b0), (b1), (b2))',
    "mysql": "SELECT 0 AS col_no, b AS col_val, COUNT(*) AS col_val_cnt FROM (SELECT"
    f" {ORACLE_RANGES.replace(chr(34), '`')} AS b FROM `S`.`T`) s GROUP BY b"
    " UNION ALL SELECT 1 AS col_no, b AS col_val, COUNT(*) AS col_val_cnt FROM (SELECT"
    " SUBSTRING(COALESCE(CAST(`NAME` AS CHAR CHARACTER SET utf8mb4) COLLATE utf8mb4_bin, '##'), 1, 100) AS b"
    " FROM `S`.`T`) s GROUP BY b"
    " UNION ALL SELECT 2 AS col_no, b AS col_val, COUNT(*) AS col_val_cnt FROM (SELECT"
    " COALESCE(DATE_FORMAT(`DAY`, '%Y%m'), '##') AS b FROM `S`.`T`) s GROUP BY b",
}


@pytest.mark.parametrize("vendor", sorted(HISTOGRAMS))
def test_histograms(vendor):
    made = statements.histogram_statement(vendor, ("S", "T"), [ID, NAME, DAY], value_chars=100, months=True)
    assert made == HISTOGRAMS[vendor]


def test_buckets_of_other_vendors():
    b = statements.bucket
    assert b("postgres", DAY) == """SUBSTR(COALESCE(CAST("DAY" AS TEXT) COLLATE "C", '##'), 1, 6)"""
    assert b("mssql", DAY, months=True) == "COALESCE(CONVERT(CHAR(6), [DAY], 112), N'##')"
    assert "ROUND([ID], 0) BETWEEN 1 AND 100 THEN N'1~100'" in b("mssql", ID, rounded=True)
    money = ColumnSpec("a'b", "Y", vendor_type="double", decimals=2)
    assert b("spark", money) == "COALESCE(CAST(CAST(`a'b` AS DECIMAL(38, 2)) AS STRING), '##')"
    assert b("mysql", ColumnSpec("x", "B", vendor_type="interval")).startswith("SUBSTRING(")
    with pytest.raises(ValueError):
        b("oracle", ColumnSpec("x", None, vendor_type="NUMBER"))


def test_types_by_name():
    names = ["NUMBER", "double precision", "REAL", "TINYINT", "timestamp(6)", "NVARCHAR2", "INTERVAL DAY TO SECOND", "POINT", None]
    kinds = ["number", "number", "number", "number", "time", "text", "other", "other", "other"]
    assert [statements.kind_of(n) for n in names] == kinds
    for name, wanted in (("CLOB", False), ("array<float>", False), ("BINARY_DOUBLE", True), ("binary", False), ("date", True)):
        assert statements.is_structured(ColumnSpec("c", vendor_type=name)) is wanted


@pytest.fixture
def odd(spark):
    rows = [(None, None, None, None), (0, "", dt.date(2024, 1, 2), 0.5), (100, "é", dt.date(2024, 1, 9), -3.0), (100, "É ", None, 1e6), (101, "##", dt.date(1999, 12, 31), 1e7), (-5, "x" * 300, None, None)]
    return spark.createDataFrame(rows, "id int, name string, day date, amount double")


def far(spark, frame, modes):
    frame.createOrReplaceTempView("odd_rows")
    local = ProfileInput(spec_from_schema(frame, "odd", decimals=2, modes=modes), frame)
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    columns = tuple(ColumnSpec(c.col_nm, c.value_mode, c.pattern, True, types[c.col_nm], c.decimals) for c in local.spec.columns)
    source = RemoteTable("spark", ("odd_rows",), spark.sql, lambda: frame)
    return local, RemoteInput(TableSpec("lake", "main", "odd", columns), source)


@pytest.mark.parametrize("options", [{}, {"months": True}, {"rounded": True, "value_chars": 100}])
def test_a_source_gives_what_files_give(spark, odd, rows, options):
    modes = {"id": "B", "name": "Y", "day": "A", "amount": "B"}
    local, there = far(spark, odd, modes)
    assert rows(remote.histogram([there], **options)) == rows(value_histogram([local], **options))
    assert rows(remote.stats([there])) == rows(column_stats([local]))
    assert rows(remote.stats([there], extreme_chars=100, batch_columns=1)) == rows(column_stats([local], extreme_chars=100))
    made, due = remote.stats([there]).schema, column_stats([local]).schema
    assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in due]
    made, due = remote.histogram([there]).schema, value_histogram([local]).schema
    assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in due]
    empty = odd.where("false")
    local, there = far(spark, empty, modes)
    assert rows(remote.stats([there])) == rows(column_stats([local]))
    assert remote.counts([there]).first().tab_cnt == 0


def test_the_plan_ships_groups_not_rows(small):
    plan = remote.counts([remote_input(small, "lineitem")])
    assert plan.columns == ["db_nm", "owner_nm", "tab_nm", "prfl_id", "tab_cnt"]


def test_registry_gives_remote_tables(spark, monkeypatch):
    asked = []
    answer = spark.range(1)
    monkeypatch.setattr(jdbc, "read_query", lambda s, o, q: asked.append(q) or answer)
    monkeypatch.setattr(jdbc, "read_table", lambda s, o, t, split=None: asked.append((t, split)) or answer)
    sources = SourceRegistry(spark)
    sources.register_jdbc("erp", {"url": "u"}, "oracle", {"A.B.T": {"numPartitions": "2"}})
    table = sources.remote("erp", "A.B", "T")
    table.run("SELECT 1")
    table.rows()
    sources.table("erp", "T", "A.B")
    assert asked == ["SELECT 1", ('"A.B"."T"', {"numPartitions": "2"}), ('"A.B"."T"', {"numPartitions": "2"})]
    sources.register_files("lake", "/nowhere")
    with pytest.raises(ValueError, match="lake"):
        sources.remote("lake", "main", "t")
    with pytest.raises(KeyError):
        sources.remote("other", "main", "t")
    sources.close("erp")
    with pytest.raises(KeyError):
        sources.remote("erp", "A.B", "T")


def test_a_run_over_a_source_equals_one_over_files(spark, small, tmp_path):
    names = ("nation", "customer")
    now = dt.datetime(2026, 1, 2)
    for n in names:
        small[n].createOrReplaceTempView(f"far_{n}")
    files = lake.segments(spark, small.root).filter(F.col("segment_nm").isin(*names))
    parts = {
        "tables": lake.tables(files), "columns": lake.columns(spark, {n: small[n] for n in names}), "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }

    def run(name, read):
        store = ResultStore(spark, str(tmp_path / name))
        collect_dictionary(spark, store, "lake", parts, now)
        register_population(store, "lake", ["main"], now)
        Profiler(store, read, "lake", decimals=2, clock=lambda: now).run(pattern_source="direct")
        master = store.master("column_master")
        return [sorted((tuple(r) for r in t.collect()), key=repr) for t in (store.master("table_master"), master, store.read("column_values"))]

    def there(_owner, tab):
        return RemoteTable("spark", (f"far_{tab}",), spark.sql, lambda: small[tab])

    def both(owner, tab):
        return there(owner, tab) if tab == "customer" else small[tab]

    due = run("files", lambda _o, tab: small[tab])
    assert run("source", there) == due
    assert run("both", both) == due
