"""Result store, sources, legacy repository and the pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabscope.operators.dictionary import lake
from tabscope.operators.dictionary.common import AllBut, stamped
from tabscope.operators.dictionary.vendors import NORMALISERS, dictionary_parts, extract_names
from tabscope.pipeline import Profiler, collect_dictionary, register_population
from tabscope.session import shared_dir
from tabscope.sources import jdbc
from tabscope.sources.legacy_repository import LegacyRepository
from tabscope.sources.registry import SourceRegistry, adhoc_query
from tabscope.sources.store import ResultStore
from verification.catalogs import KEPT, extract

RUN = dt.datetime(2026, 1, 2, 3, 4, 5)


@pytest.fixture
def store(spark, tmp_path):
    return ResultStore(spark, str(tmp_path / "store"))


def dictionary(spark, *names):
    frame = spark.createDataFrame([(n, 1) for n in names], "tab_nm string, row_cnt bigint")
    return frame.select(F.lit("A").alias("owner_nm"), "*")


def test_snapshot_is_replaced_also_by_nothing(spark, store, rows):
    def load(chasu, *names, db="db"):
        store.replace_scope(
            "dic_tables", stamped(dictionary(spark, *names), db, chasu, RUN.date()),
            {"db_nm": db, "chasu": chasu},
        )

    assert store.read("dic_tables").isEmpty()
    load(1, "a", "b"); load(2, "c"); load(1, "z", db="01")
    load(1, "b")
    assert rows(store.read("dic_tables"), "db_nm", "chasu", "tab_nm") == [("01", 1, "z"), ("db", 1, "b"), ("db", 2, "c")]
    load(2)
    assert rows(store.read("dic_tables"), "db_nm", "chasu", "tab_nm") == [("01", 1, "z"), ("db", 1, "b")]


def histogram(spark, table, *pairs, owner="A/B 한=1"):
    return spark.createDataFrame(
        [("db", "P01", owner, table, "c", v, n) for v, n in pairs],
        "db_nm string, prfl_id string, owner_nm string, tab_nm string, col_nm string, col_val string, col_val_cnt bigint",
    )


def test_histograms_are_replaced_per_table(spark, store, rows):
    scope = lambda t: {"db_nm": "db", "prfl_id": "P01", "owner_nm": "A/B 한=1", "tab_nm": t}
    both = histogram(spark, "t", ("x", 1), ("y", 2)).unionByName(histogram(spark, "u", ("z", 3)))
    store.replace_scopes("column_values", both, [scope("t"), scope("u")])
    store.replace_scopes("column_values", histogram(spark, "t", ("n", 9)), [scope("t")])
    got = rows(store.read("column_values"), "owner_nm", "tab_nm", "col_val", "col_val_cnt")
    assert got == [("A/B 한=1", "t", "n", 9), ("A/B 한=1", "u", "z", 3)]
    store.replace_scopes("column_values", histogram(spark, "t").limit(0), [scope("u")])
    assert rows(store.read("column_values"), "tab_nm") == [("t",)]
    with pytest.raises(ValueError):
        store.replace_scopes("column_values", both, [{"db_nm": "db"}])


def test_patterns_are_replaced_per_profile(spark, store, rows):
    def patterns(table):
        return spark.createDataFrame(
            [("A", table, "c", "CC", 1, "100.00")],
            "owner_nm string, tab_nm string, col_nm string, col_pat string, col_pat_cnt bigint, col_pat_rt string",
        )

    for prfl, table in (("P01", "t"), ("P02", "t"), ("P01", "u")):
        store.replace_scope("column_patterns", patterns(table), {"db_nm": "db", "prfl_id": prfl})
    assert rows(store.read("column_patterns"), "prfl_id", "tab_nm") == [("P01", "u"), ("P02", "t")]


def test_scope_must_follow_the_layout(spark, store):
    with pytest.raises(ValueError):
        store.replace_scope("dic_tables", dictionary(spark, "a"), {"chasu": 1})
    with pytest.raises(ValueError):
        store.replace_scope("dic_tables", dictionary(spark, "a"), {"db_nm": "", "chasu": 1})


def test_append_and_master_revisions(spark, store, rows):
    store.append("column_values", histogram(spark, "t", ("x", 1)))
    store.append("column_values", histogram(spark, "t", ("x", 1)))
    assert store.read("column_values").count() == 2
    assert store.latest_revision("table_master") == 0
    for n in (1, 2):
        current = store.master("table_master")
        store.write_master("table_master", current.unionByName(
            spark.createDataFrame([(f"t{n}",)], "tab_nm string"), allowMissingColumns=True))
    assert store.latest_revision("table_master") == 2
    assert rows(store.master("table_master"), "tab_nm") == [("t1",), ("t2",)]


def failing(frame):
    """The rows of ``frame``, then a task that fails."""
    return frame.where(F.raise_error(F.lit("lost")).isNull() | F.lit(False))


def test_a_load_that_fails_changes_nothing(spark, store, rows):
    scope = {"db_nm": "db", "prfl_id": "P01", "owner_nm": "A", "tab_nm": "t"}
    master = spark.createDataFrame([("t1",), ("t2",)], "tab_nm string")
    store.write_master("table_master", master)
    store.replace_scopes("column_values", histogram(spark, "t", ("x", 1), owner="A"), [scope])
    snapshot = {"db_nm": "db", "chasu": 1}
    store.replace_scope("dic_tables", stamped(dictionary(spark, "a", "b"), "db", 1, RUN.date()), snapshot)
    for load in (
        lambda: store.write_master("table_master", failing(store.master("table_master"))),
        lambda: store.replace_scopes("column_values", failing(histogram(spark, "t", ("y", 2), owner="A")), [scope]),
        lambda: store.replace_scope("dic_tables", failing(stamped(dictionary(spark, "z"), "db", 1, RUN.date())), snapshot),
    ):
        with pytest.raises(Exception, match="lost"):
            load()
    assert rows(store.master("table_master"), "tab_nm") == [("t1",), ("t2",)]
    assert rows(store.read("column_values"), "col_val") == [("x",)]
    assert rows(store.read("dic_tables"), "tab_nm") == [("a",), ("b",)]


def test_an_incomplete_snapshot_is_not_the_latest(spark, store, small):
    parts = {"tables": lake.tables(lake.segments(spark, small.root)), "columns": lake.columns(spark, {"nation": small["nation"]})}
    assert collect_dictionary(spark, store, "lake", parts, RUN) == 1
    with pytest.raises(Exception, match="lost"):
        collect_dictionary(spark, store, "lake", {**parts, "columns": failing(parts["columns"])}, RUN)
    assert store.read("dic_snapshots").count() == 1
    assert collect_dictionary(spark, store, "lake", parts, RUN) == 2


def test_superseded_loads_are_removed(spark, store, tmp_path):
    for n in range(6):
        store.write_master("table_master", spark.createDataFrame([(f"t{n}",)], "tab_nm string"))
    held = [p.name for p in (tmp_path / "store" / "table_master").iterdir() if p.name.startswith("load=")]
    assert len(held) == 2
    assert store.latest_revision("table_master") == 6


def test_a_reader_keeps_its_rows_while_a_load_replaces_them(spark, store, rows):
    store.write_master("table_master", spark.createDataFrame([("old",)], "tab_nm string"))
    before = store.master("table_master")
    store.write_master("table_master", before.withColumn("tab_nm", F.lit("new")))
    assert rows(before, "tab_nm") == [("old",)]
    assert rows(store.master("table_master"), "tab_nm") == [("new",)]


def test_registry(spark, caplog, small):
    sources = SourceRegistry(spark)
    first = sources.register_files("lake", small.root)
    assert sources.register("lake", lambda table: None) is first
    assert "already registered" in caplog.text
    assert sources.table("lake", "region").count() == 5
    with pytest.raises(KeyError, match="lake"):
        sources.get("other")
    assert sources.list() == ["lake"]
    small["region"].createOrReplaceTempView("region_view")
    sources.register("views", spark.table)
    assert sources.table("views", "region_view").count() == 5
    sources.close("lake"); sources.close("lake")
    assert sources.list() == ["views"]
    sources.close_all()
    assert sources.list() == []


def test_adhoc_query(spark, small):
    got = adhoc_query(spark, "SELECT count(*) AS n FROM {r} WHERE r_name <> :x", {"r": small["region"]}, {"x": "ASIA"})
    assert got.first().n == 4
    assert adhoc_query(spark, "SELECT 1 AS one").first().one == 1


def test_jdbc_options(monkeypatch):
    login = jdbc.Credentials("u", "p")
    assert jdbc.oracle("h", service_name="s", sid="x", credentials=login)["url"] == "jdbc:oracle:thin:@//h:1521/s"
    assert jdbc.oracle("h", 1522, sid="x")["url"] == "jdbc:oracle:thin:@h:1522:x"
    with pytest.raises(ValueError):
        jdbc.oracle("h")
    pg = jdbc.postgres(database="d", credentials=login)
    assert (pg["url"], pg["user"], pg["driver"]) == ("jdbc:postgresql://localhost:5432/d", "u", "org.postgresql.Driver")
    assert jdbc.mssql("h", database="d")["url"] == "jdbc:sqlserver://h:1433;databaseName=d"
    assert jdbc.mssql("h", driver="my.Driver")["driver"] == "my.Driver"
    assert jdbc.mysql("h", database="d")["url"] == "jdbc:mariadb://h:3306/d?useUnicode=true&characterEncoding=UTF-8"
    assert "user" not in jdbc.mysql("h")
    assert jdbc.split_read("id", 1, 100, 8) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.split_read("id", 1, 100, 0)
    assert "secret" not in repr(jdbc.Credentials("u", "secret"))
    monkeypatch.setenv("DB_USER", "a"); monkeypatch.setenv("DB_PASS", "b")
    assert jdbc.Credentials.from_env("DB_USER", "DB_PASS") == jdbc.Credentials("a", "b")


def test_jdbc_names_and_pushed_queries(spark, monkeypatch):
    assert jdbc.quoted("oracle", "Sales", "order lines") == '"Sales"."order lines"'
    assert jdbc.quoted("mssql", "dbo", "a]b") == "[dbo].[a]]b]"
    assert jdbc.quoted("mysql", "s", "gr`oup") == "`s`.`gr``oup`"
    assert jdbc.bounds_query("postgres", "s", "t", "Id") == 'SELECT MIN("Id") AS lower_bound, MAX("Id") AS upper_bound FROM "s"."t"'
    assert jdbc.count_query("mysql", "s", "t") == "SELECT COUNT(*) AS tab_cnt FROM `s`.`t`"
    assert jdbc.schema_predicates("OWNER", ["A", "O'B"]) == ["OWNER = 'A'", "OWNER = 'O''B'"]
    asked = []
    answer = spark.createDataFrame([(3, 99)], "lower_bound int, upper_bound int")
    monkeypatch.setattr(jdbc, "read_query", lambda s, o, q: asked.append(q) or answer)
    split = jdbc.split_by_key(spark, {}, "oracle", "A", "T", "ID", 7)
    assert split == {"partitionColumn": '"ID"', "lowerBound": "3", "upperBound": "99", "numPartitions": "7"}
    assert asked == ['SELECT MIN("ID") AS lower_bound, MAX("ID") AS upper_bound FROM "A"."T"']
    monkeypatch.setattr(jdbc, "read_query", lambda s, o, q: answer.selectExpr("null", "null"))
    assert jdbc.split_by_key(spark, {}, "oracle", "A", "T", "ID", 7) == {}
    opened = []
    monkeypatch.setattr(jdbc, "read_table", lambda s, o, t, split=None: opened.append((t, split)))
    sources = SourceRegistry(spark)
    sources.register_jdbc("erp", {"url": "u"}, "mssql", {"dbo.My Table": split})
    sources.table("erp", "dbo.My Table")
    assert opened == [("[dbo].[My Table]", split)]


def test_schema_columns_belong_to_extracts():
    for vendor, columns in jdbc.SCHEMA_COLUMNS.items():
        assert set(columns) <= set(jdbc.CATALOGS[vendor])


def test_collection_by_exclusion(small):
    extracts = {n: extract(small, n) for n in extract_names("oracle")}
    parts = dictionary_parts("oracle", extracts, AllBut("oracle", (KEPT[0],)))
    for part in parts.values():
        assert {r.owner_nm for r in part.select("owner_nm").distinct().collect()} == set(KEPT[1:])


@pytest.mark.parametrize("vendor", sorted(NORMALISERS))
def test_every_extract_of_a_vendor_has_a_source(vendor):
    assert set(extract_names(vendor)) == set(jdbc.CATALOGS[vendor])


def test_vendor_dictionary(small):
    extracts = {n: extract(small, n) for n in extract_names("postgres")}
    parts = dictionary_parts("postgres", extracts, KEPT)
    assert set(parts) == {"tables", "columns", "segments", "constraints", "constraint_columns", "indexes"}
    assert all(not df.isEmpty() for df in parts.values())


def test_legacy_repository(spark, tmp_path):
    schemas = spark.createDataFrame([(7, "A")], "`DB번호` int, `스키마명` string")
    tables = spark.createDataFrame([(7, "A", "T")], "`DB번호` int, `스키마명` string, `테이블명` string")
    columns = spark.createDataFrame([(7, "A", "C", 0), (7, "A", "D", 2)], "`DB번호` int, `스키마명` string, `컬럼명` string, `소수점` int")
    repository = LegacyRepository(spark, str(tmp_path))
    repository.save(schemas, tables, columns, 7)
    stored = spark.read.parquet(str(tmp_path / "프로파일링_컬럼정보"))
    assert sorted((r.컬럼명, r.소수점) for r in stored.collect()) == [("C", None), ("D", 2)]
    with pytest.raises(ValueError):
        repository.save(schemas, tables, columns, 7)
    repository.save(schemas, tables, columns.filter(F.col("컬럼명") == "D"), 7, ignore=True)
    assert spark.read.parquet(str(tmp_path / "프로파일링_컬럼정보")).count() == 1
    eight = schemas.withColumn("DB번호", F.lit(8))
    assert not repository.has_rows((eight, tables, columns), 8)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) in (spark.conf.get("spark.checkpoint.dir"), spark.sparkContext.getCheckpointDir())


@pytest.fixture(scope="module")
def profiled(spark, small, tmp_path_factory):
    """Dictionary, registration and every level over three tables."""
    store = ResultStore(spark, str(tmp_path_factory.mktemp("run")))
    names = ("nation", "customer", "embeddings")
    frames = {n: small[n] for n in names}
    files = lake.segments(spark, small.root).filter(F.col("segment_nm").isin(*names))
    parts = {
        "tables": lake.tables(files), "columns": lake.columns(spark, frames), "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }
    with pytest.raises(ValueError):
        register_population(store, "lake", ["main"], RUN)
    assert collect_dictionary(spark, store, "lake", parts, RUN) == 1
    assert collect_dictionary(spark, store, "lake", parts, RUN) == 2
    assert register_population(store, "lake", ["main"], RUN) == 2
    ticks = iter(RUN + dt.timedelta(seconds=i) for i in range(1000))
    profiler = Profiler(store, lambda _o, tab: frames[tab], "lake", decimals=2, tables_per_job=2, clock=lambda: next(ticks))
    profiler.run()
    return store, profiler


def test_pipeline_results(profiled):
    store, _ = profiled
    tables = {r.tab_nm: r for r in store.master("table_master").collect()}
    assert tables["nation"].tab_cnt == 25 and tables["nation"].chasu == 2
    assert tables["nation"].tabcnt_str_dt < tables["nation"].tabcnt_end_dt
    columns = {(r.tab_nm, r.col_nm): r for r in store.master("column_master").collect()}
    name = columns["nation", "n_name"]
    assert (name.notnull_cnt, name.col_kind, name.top_col_pat) == (25, 25, "CCCCCC$CC")
    assert name.sample_data == "NATION_0 | NATION_1 | NATION_10"
    assert columns["embeddings", "embedding"].notnull_cnt is None
    assert columns["nation", "n_nationkey"].sample_data is None


def test_pipeline_levels_can_run_alone(profiled, rows):
    store, profiler = profiled
    before = store.read("column_patterns").count()
    profiler.run(levels=("pattern",), pattern_source="direct")
    assert store.read("column_patterns").count() == before
    profiler.run_value_level()
    assert profiler.values().groupBy("tab_nm", "col_nm", "col_val").count().filter("count > 1").isEmpty()
    with pytest.raises(ValueError):
        profiler.run(levels=("rows",))
    with pytest.raises(ValueError):
        profiler.run_pattern_level("nowhere")


def test_a_level_of_many_jobs_writes_the_master_once(spark, small, tmp_path, monkeypatch, caplog):
    """Seven tables, two a job: lazy opening, one master write a level, a window a table."""
    store = ResultStore(spark, str(tmp_path / "many"))
    names = [f"n{i}" for i in range(7)]
    frames = {n: small["nation"] for n in names}
    files = lake.segments(spark, small.root).filter("segment_nm = 'nation'")
    files = files.drop("segment_nm").join(spark.createDataFrame([(n,) for n in names], "segment_nm string")).select(*files.columns)
    parts = {
        "tables": lake.tables(files), "columns": lake.columns(spark, frames), "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }
    collect_dictionary(spark, store, "lake", parts, RUN)
    register_population(store, "lake", ["main"], RUN)
    opened, written = [], []
    write = store.write_master
    monkeypatch.setattr(store, "write_master", lambda name, df: (written.append((name, len(opened))), write(name, df)))

    def read(_owner, tab):
        opened.append(tab)
        return frames[tab].drop("n_regionkey") if tab == "n3" else frames[tab]

    ticks = iter(RUN + dt.timedelta(seconds=i) for i in range(1000))
    profiler = Profiler(store, read, "lake", tables_per_job=2, counts_at_once=1, clock=lambda: next(ticks))
    jobs = profiler._jobs(None)
    assert [len(next(jobs)), len(opened)] == [2, 2]
    opened.clear()
    profiler.run(levels=("table", "column"))
    assert written == [("table_master", 7), ("column_master", 14)]
    assert "n3 no longer has the registered columns n_regionkey" in caplog.text
    tables = store.master("table_master").collect()
    assert {r.tab_cnt for r in tables} == {25}
    assert len({(r.tabcnt_str_dt, r.tabcnt_end_dt) for r in tables}) == 7
    assert all(r.tabcnt_str_dt < r.tabcnt_end_dt for r in tables)
    columns = {(r.tab_nm, r.col_nm): r.notnull_cnt for r in store.master("column_master").collect()}
    assert columns["n3", "n_regionkey"] is None and columns["n4", "n_regionkey"] == 25
    profiler.run_pattern_level("direct")
    assert store.read("column_patterns").select("tab_nm").distinct().count() == 7
    assert not list((tmp_path / "many" / "_staging").iterdir())
