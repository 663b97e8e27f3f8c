"""The store's log of loads, and levels that take up where they failed."""

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tabscope.operators.dictionary import lake
from tabscope.pipeline import Profiler, collect_dictionary, register_population
from tabscope.sources import files as files_module
from tabscope.sources import scopelog
from tabscope.sources.files import SmallFiles
from tabscope.sources.scopelog import Changed, ScopeLog
from tabscope.sources.store import ResultStore
from tests.test_store_and_sources import RUN, histogram


def scope(table, owner="A"):
    return {"db_nm": "db", "prfl_id": "P01", "owner_nm": owner, "tab_nm": table}


@pytest.mark.parametrize("way", ["link", "create", "rename"])
def test_of_many_writers_one_gets_the_name(spark, tmp_path, monkeypatch, way):
    """The object-store and HDFS ways on the local file system, one writer after another."""
    files = SmallFiles(spark)
    place = f"file://{tmp_path}/log/1.json"
    if way == "create":
        monkeypatch.setattr(files, "_link", lambda target, data: files._create(*files.at(place), data, None))
    if way == "rename":  # the local rename would replace; those of ATOMIC_RENAME refuse
        monkeypatch.setattr(
            files, "_link", lambda target, data: not files.exists(place) and files._rename(*files.at(place), data)
        )
    (tmp_path / "log").mkdir()
    writers = [f"writer {i}".encode() for i in range(8)]
    if way == "link":
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda d: files.put_if_absent(place, d), writers))
    else:
        won = [files.put_if_absent(place, d) for d in writers]
    assert won.count(True) == 1
    assert files.read(place) == writers[won.index(True)]
    assert [n for n, _, _ in files.listed(f"file://{tmp_path}/log") if not n.endswith(".crc")] == ["1.json"]


def test_unknown_stores_are_refused(spark, tmp_path, monkeypatch):
    files = SmallFiles(spark)
    fs, path = files.at(f"file://{tmp_path}/x")

    class Elsewhere:
        def getUri(self):
            return self

        def getScheme(self):
            return "ftp"

    monkeypatch.setattr(files, "at", lambda location: (Elsewhere(), path))
    with pytest.raises(NotImplementedError, match="ftp"):
        files.put_if_absent("ftp://x", b"")
    assert not files_module.ATOMIC_RENAME & set(files_module.CONDITIONAL_CREATE)


def test_six_disjoint_loads_at_once_all_succeed(spark, tmp_path, rows):
    root = str(tmp_path / "store")
    ready = threading.Barrier(6)

    def load(n):
        store = ResultStore(spark, root)
        store.view("column_values")
        ready.wait()
        store.replace_scopes("column_values", histogram(spark, f"t{n}", ("x", n), owner="A"), [scope(f"t{n}")])

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(load, range(6)))
    store = ResultStore(spark, root)
    assert rows(store.read("column_values"), "tab_nm", "col_val_cnt") == [(f"t{n}", n) for n in range(6)]
    assert store.latest_revision("column_values") == 6
    named = {d.split("/")[0] for ds in store.view("column_values").scopes.values() for d in ds}
    held = {p.name for p in (tmp_path / "store" / "column_values").iterdir() if p.name.startswith("load=")}
    assert held == named and len(held) == 6


def test_loads_of_one_scope_conflict_and_leave_nothing(spark, tmp_path, rows):
    store = ResultStore(spark, str(tmp_path / "store"))
    store.replace_scopes("column_values", histogram(spark, "t", ("x", 1), owner="A"), [scope("t")])
    first, second = ResultStore(spark, store._root), ResultStore(spark, store._root)
    ready = threading.Barrier(2)

    def load(own, n):
        since = own.view("column_values")
        ready.wait()
        try:
            own._load("column_values", histogram(spark, "t", ("y", n), owner="A"), [scope("t")], {}, since)
        except Changed:
            return None
        return n

    with ThreadPoolExecutor(2) as pool:
        won = [n for n in pool.map(load, (first, second), (7, 8)) if n]
    assert len(won) == 1
    assert rows(store.read("column_values"), "col_val_cnt") == [(won[0],)]
    held = [p.name for p in (tmp_path / "store" / "column_values").iterdir() if p.name.startswith("load=")]
    assert len(held) == 2  # the present one, and the one just replaced


def test_updates_of_a_master_are_not_lost(spark, tmp_path, rows):
    root = str(tmp_path / "store")
    ResultStore(spark, root).write_master("table_master", spark.createDataFrame([("t",)], "tab_nm string"))

    def add(n):
        extra = spark.createDataFrame([(f"n{n}",)], "tab_nm string")
        ResultStore(spark, root).update_master("table_master", lambda m: m.unionByName(extra, allowMissingColumns=True))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(4)))
    assert rows(ResultStore(spark, root).master("table_master"), "tab_nm") == [("n0",), ("n1",), ("n2",), ("n3",), ("t",)]
    a, b = ResultStore(spark, root), ResultStore(spark, root)
    mine = a.master("table_master")
    b.write_master("table_master", b.master("table_master").limit(1))
    with pytest.raises(Changed):
        a.write_master("table_master", mine)


def entry(n):
    return f"db=1/t={n}", [f"load={n:032d}/db=1/t={n}"]


def test_bytes_per_publish_do_not_grow_with_held_scopes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scopelog, "LEAST_BYTES", 2000)
    files = SmallFiles(spark)
    written = []
    put = files.put_if_absent
    monkeypatch.setattr(files, "put_if_absent", lambda at, data: written.append((at, len(data))) or put(at, data))
    log = ScopeLog(files, str(tmp_path / "table"))
    per_hundred = []
    for n in range(400):
        name, held = entry(n)
        log.commit([name], {name: held}, log.view())
        if n % 100 == 99:
            per_hundred.append(sum(size for _, size in written))
            written.clear()
    entries = [400 * 130 / 4] * 4
    assert len(log.view().scopes) == 400
    # Entries, and snapshots whose size doubles ever more rarely: no more than thrice the entries.
    assert all(total < 3.5 * due * 1.6 for total, due in zip(per_hundred, entries, strict=True))
    left = [n for n, _, _ in files.listed(str(tmp_path / "table" / "_log")) if n.endswith(".json")]
    assert len(left) < 250
    fresh = ScopeLog(files, str(tmp_path / "table")).view()
    assert (fresh.number, fresh.scopes) == (400, dict(entry(n) for n in range(400)))


def test_a_reader_finds_the_log_while_it_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scopelog, "LEAST_BYTES", 300)
    files = SmallFiles(spark)
    writer, reader = (ScopeLog(files, str(tmp_path / "table")) for _ in range(2))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            view = reader.view()
            seen.append((view.number, len(view.scopes)))

    thread = threading.Thread(target=read)
    thread.start()
    for n in range(60):
        name, held = entry(n)
        writer.commit([name], {name: held}, writer.view())
    stop.set()
    thread.join()
    assert seen and all(a == b for a, b in seen)


def test_scopes_of_a_read_open_their_directories_only(spark, tmp_path, rows):
    store = ResultStore(spark, str(tmp_path / "store"))
    for table in ("t", "u"):
        store.replace_scopes("column_values", histogram(spark, table, ("x", 1), owner="A"), [scope(table)])
    one = store.read("column_values", scope("u"))
    assert rows(one, "tab_nm") == [("u",)] and len(one.inputFiles()) == 1
    assert store.read("column_values", {"db_nm": "other"}).isEmpty()
    with pytest.raises(ValueError):
        store.read("column_values", {"tab_nm": "u"})


def test_what_a_killed_load_leaves_is_swept(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "store"))
    store.replace_scopes("column_values", histogram(spark, "t", ("x", 1), owner="A"), [scope("t")])
    stray = tmp_path / "store" / "column_values" / "load=stray"
    stray.mkdir()
    assert store.vacuum("column_values") == []
    assert store.vacuum("column_values", hours=-1) == ["load=stray"]
    assert store.read("column_values").count() == 1


# Levels ---------------------------------------------------------------------------------

NAMES = [f"n{i}" for i in range(8)]


@pytest.fixture
def estate(spark, small, tmp_path):
    """Eight registered tables, two a job; a reader that can be told to fail."""
    frames = {n: small["nation"].withColumn("extra", F.lit(i)) for i, n in enumerate(NAMES)}
    files = lake.segments(spark, small.root).filter("segment_nm = 'nation'")
    files = files.drop("segment_nm").join(spark.createDataFrame([(n,) for n in NAMES], "segment_nm string")).select(*files.columns)
    parts = {
        "tables": lake.tables(files), "columns": lake.columns(spark, frames), "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }

    def make(name):
        store = ResultStore(spark, str(tmp_path / name))
        collect_dictionary(spark, store, "lake", parts, RUN)
        register_population(store, "lake", ["main"], RUN)
        opened, broken = [], set()

        def read(_owner, tab):
            opened.append(tab)
            frame = frames[tab]
            if tab in broken:
                return frame.withColumn("n_name", F.when(F.raise_error(F.lit("lost")).isNull(), F.col("n_name")))
            return frame

        def profiler(**options):
            return Profiler(store, read, "lake", tables_per_job=2, counts_at_once=1, clock=lambda: RUN, **options)

        return store, profiler, opened, broken

    return make


def columns_of(store):
    drop = {"cr_dt", "up_dt"}
    master = store.master("column_master")
    return sorted((tuple(r) for r in master.select(*[c for c in master.columns if c not in drop]).collect()), key=repr)


def test_a_column_level_takes_up_where_it_failed(estate):
    clean, run_clean, _, _ = estate("clean")
    run_clean().run_column_level()
    store, profiler, opened, broken = estate("failing")
    broken.add("n5")  # job 3 of 4
    with pytest.raises(Exception, match="lost"):
        profiler().run_column_level()
    assert opened == NAMES[:6]
    assert all(r.notnull_cnt is None for r in store.master("column_master").collect())
    broken.clear()
    opened.clear()
    profiler().run_column_level()
    assert opened == NAMES[4:]
    assert columns_of(store) == columns_of(clean)
    opened.clear()
    profiler().run_column_level()  # a level that ended well starts over
    assert opened == NAMES


@pytest.mark.parametrize("level", ["value", "pattern"])
def test_other_levels_take_up_as_well(estate, level):
    def go(profiler):
        if level == "value":
            profiler.run_value_level()
        else:
            profiler.run_pattern_level("direct")

    clean, run_clean, _, _ = estate("clean")
    go(run_clean())
    store, profiler, opened, broken = estate("failing")
    broken.add("n4")
    with pytest.raises(Exception, match="lost"):
        go(profiler())
    broken.clear()
    opened.clear()
    go(profiler())
    assert opened == NAMES[4:]
    assert columns_of(store) == columns_of(clean)
    table = {"value": "column_values", "pattern": "column_patterns"}[level]
    key = lambda s: sorted((tuple(r) for r in s.read(table).collect()), key=repr)
    assert key(store) == key(clean)


def test_a_changed_plan_or_an_old_failure_starts_over(estate, spark):
    store, profiler, opened, broken = estate("failing")
    broken.add("n7")
    with pytest.raises(Exception, match="lost"):
        profiler().run_column_level()
    master = store.master("column_master")
    off = (F.col("tab_nm") == "n1") & (F.col("col_nm") == "extra")
    store.write_master("column_master", master.withColumn("use_yn", F.when(off, "N").otherwise(F.col("use_yn"))))
    broken.clear()
    opened.clear()
    profiler().run_column_level()
    assert opened == ["n1", "n6", "n7"]  # the changed one, and the failed job
    extra = {r.tab_nm: r.notnull_cnt for r in store.master("column_master").where("col_nm = 'extra'").collect()}
    assert extra["n1"] is None and extra["n0"] == extra["n7"] == 25
    for options in ({"resume_within": None}, {"clock": None}):
        broken.add("n7")
        with pytest.raises(Exception, match="lost"):
            profiler().run_column_level()
        broken.clear()
        opened.clear()
        if "clock" in options:
            late = Profiler(store, profiler()._read, "lake", tables_per_job=2, clock=lambda: RUN + dt.timedelta(days=3))
            late.run_column_level()
        else:
            profiler(**options).run_column_level()
        assert opened == NAMES


def test_a_failed_merge_reads_no_table_again(estate, monkeypatch):
    store, profiler, opened, _ = estate("failing")
    write = store.write_master
    monkeypatch.setattr(store, "write_master", lambda name, df: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        profiler().run_table_level()
    monkeypatch.setattr(store, "write_master", write)
    opened.clear()
    profiler().run_table_level()
    assert opened == []
    assert {r.tab_cnt for r in store.master("table_master").collect()} == {25}
