"""Profiles of growing tables: new files only, sketches, jobs by size."""

import datetime as dt
import math
import threading

import pytest
from pyspark.sql import functions as F

from tabscope.operators import incremental
from tabscope.operators.dictionary import lake
from tabscope.operators.ranking import global_running
from tabscope.operators.sketches import bound, distinct_sketches, estimates, union_sketches
from tabscope.operators.value_dist import value_histogram
from tabscope.pipeline import Profiler, collect_dictionary, register_population
from tabscope.plans import packing
from tabscope.plans.spec import ProfileInput, spec_from_schema
from tabscope.sources.lake_files import LakeTable
from tabscope.sources.store import ResultStore

SCHEMA = "k int, v string, x double"
NOW = dt.datetime(2026, 1, 2, 3, 4, 5)


@pytest.fixture
def loads(spark, tmp_path):
    """A lake table that grows file by file, and its plan."""
    root = tmp_path / "lake folder" / "t"

    def put(name, *rows):
        frame = spark.createDataFrame(list(rows), SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(str(root / name))

    put("a", (1, "x", 0.5), (2, "y", None), (3, None, 2.0))
    table = LakeTable(spark, str(root), SCHEMA)
    spec = spec_from_schema(table.frame(), "t", decimals=2, modes={"k": "B", "v": "Y", "x": None})
    return table, spec, put


def same(store, table, spec, rows):
    made = incremental.current(store, incremental.HISTOGRAM, spec)
    due = value_histogram([ProfileInput(spec, table.frame())])
    assert rows(made, *sorted(made.columns)) == rows(due, *sorted(due.columns))


@pytest.mark.parametrize("named", [10_000, 0])
def test_only_new_files_are_read(spark, tmp_path, loads, rows, monkeypatch, named):
    monkeypatch.setattr(incremental, "NAMED_FILES", named)
    table, spec, put = loads
    store = ResultStore(spark, str(tmp_path / "store"))
    read = []
    kind = incremental.HISTOGRAM

    def partial(source, **options):
        read.append(sorted(f.split("/t/")[1].split("/")[0] for f in source.frame.inputFiles()))
        return kind.partial(source, **options)

    watched = incremental.Kind(kind.files, kind.parts, partial, kind.merged)
    refresh = lambda: incremental.refresh(store, watched, spec, table)
    assert refresh() == 1
    same(store, table, spec, rows)
    assert refresh() == 0
    put("b", (1, "x", None), (200, "z", 1.0))
    assert refresh() == 1
    same(store, table, spec, rows)
    put("a", (9, "x", 0.0))  # replaced
    assert refresh() == 1
    same(store, table, spec, rows)
    if named:
        assert read == [["a"], ["b"], ["a"]]
    before = store.read(kind.parts).count()
    incremental.compact(store, kind, spec)
    assert store.read(kind.parts).count() < before
    same(store, table, spec, rows)
    for file in (tmp_path / "lake folder" / "t" / "b").iterdir():
        file.unlink()
    assert refresh() == 0
    same(store, table, spec, rows)


def test_a_refresh_that_fails_changes_nothing(spark, tmp_path, loads, rows, monkeypatch):
    table, spec, put = loads
    store = ResultStore(spark, str(tmp_path / "store"))
    incremental.refresh(store, incremental.HISTOGRAM, spec, table)
    put("b", (1, "q", None))
    replace = store.replace_scope
    monkeypatch.setattr(store, "replace_scope", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        incremental.refresh(store, incremental.HISTOGRAM, spec, table)
    made = incremental.current(store, incremental.HISTOGRAM, spec)
    assert "q" not in {r.col_val for r in made.collect()}
    monkeypatch.setattr(store, "replace_scope", replace)
    assert incremental.refresh(store, incremental.HISTOGRAM, spec, table) == 1
    same(store, table, spec, rows)


def test_the_profiler_refreshes_values(spark, tmp_path, small):
    root = tmp_path / "t"
    small["nation"].coalesce(1).write.parquet(str(root / "a"))
    table = LakeTable(spark, str(root), "n_nationkey int, n_name string, n_regionkey int")
    store = ResultStore(spark, str(tmp_path / "store"))
    files = lake.segments(spark, str(tmp_path / "t")).withColumn("segment_nm", F.lit("t"))
    parts = {
        "tables": lake.tables(files), "columns": lake.columns(spark, {"t": table.frame()}), "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }
    collect_dictionary(spark, store, "lake", parts, NOW)
    register_population(store, "lake", ["main"], NOW)
    profiler = Profiler(store, lambda _o, _t: table.frame(), "lake", clock=lambda: NOW)
    assert profiler.refresh_values(lambda _o, _t: table) == {("main", "t"): 1}
    small["nation"].limit(3).coalesce(1).write.parquet(str(root / "b"))
    assert profiler.refresh_values(lambda _o, _t: table) == {("main", "t"): 1}
    assert profiler.refresh_values(lambda _o, _t: table) == {("main", "t"): 0}
    refreshed = sorted(tuple(r) for r in profiler.values().select("col_nm", "col_val", "col_val_cnt").collect())
    profiler.run_value_level()
    assert refreshed == sorted(tuple(r) for r in profiler.values().select("col_nm", "col_val", "col_val_cnt").collect())


def test_sketches_merge_and_stay_in_bounds(spark):
    frame = spark.range(30_000).selectExpr(
        "id", "id % 7 AS few", "cast(id AS string) AS t", "if(id % 3 = 0, null, id / 8) AS d",
        "if(id % 2 = 0, 0.0D, -0.0D) AS z", "cast(null AS string) AS nothing",
        "date_add(date'2000-01-01', cast(id % 1000 AS int)) AS day",
    )
    spec = spec_from_schema(frame, "t", modes={})
    parts = [distinct_sketches([ProfileInput(spec, frame.where(f"id % 2 = {i}"))]) for i in (0, 1)]
    whole = estimates(union_sketches(parts[0].unionByName(parts[1])))
    found = {r.col_nm: r for r in whole.collect()}
    exact = {"id": 30_000, "few": 7, "t": 30_000, "d": 20_000, "z": 1, "day": 1000, "nothing": 0}
    for name, n in exact.items():
        assert found[name].least_kind <= n <= found[name].most_kind, name
    assert bound(12) == pytest.approx(3 * 1.04 / 64)


def packed_plainly(tables, job_mb, most):
    jobs, small, slots = [], [0, 0], {}
    for owner, tab, mb in sorted(tables, key=lambda t: (-(t[2] or 0), t[0], t[1])):
        mb = mb or 0
        if mb >= job_mb:
            key = ("own", owner, tab)
        else:
            key = ("shared", small[0] // job_mb, small[1] // most)
            small[0] += mb
            small[1] += 1
        if key not in slots:
            slots[key] = len(slots) + 1
        jobs.append((owner, tab, mb, slots[key]))
    return sorted(jobs)


def test_a_huge_table_has_a_job_of_its_own(spark):
    tables = [("A", "huge", 900_000), ("A", "big", 70_000)] + [("B", f"t{i:03d}", i % 9) for i in range(120)] + [("C", "unknown", None)]
    frame = spark.createDataFrame(tables, "owner_nm string, tab_nm string, tab_size bigint")
    made = packing.packed(frame, job_mb=65_536, most_tables=50).collect()
    assert sorted((r.owner_nm, r.tab_nm, r.tab_size or 0, r.job_no) for r in made) == packed_plainly(tables, 65_536, 50)
    jobs = {}
    for r in made:
        jobs.setdefault(r.job_no, []).append(r.tab_nm)
    assert jobs[1] == ["huge"] and jobs[2] == ["big"]
    assert [len(jobs[n]) for n in (3, 4, 5)] == [50, 50, 21]
    made = packing.packed(frame, job_mb=20, most_tables=50).collect()
    assert sorted((r.owner_nm, r.tab_nm, r.tab_size or 0, r.job_no) for r in made) == packed_plainly(tables, 20, 50)


def test_running_sums_cross_partitions(spark):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") * 37 % 1000 % 5).alias("v")).repartition(7)
    made = global_running(frame, [F.col("k")], "nr", {"v": "before"}).orderBy("k").collect()
    assert [r.nr for r in made] == list(range(1, 1001))
    assert all(r.before == sum(i % 5 for i in range(r.k)) for r in made)


def test_pools_weigh_tiers(spark):
    text = packing.allocation_file()
    assert text.count("<pool ") == 4 and '<pool name="tier-16">' in text and "<weight>16</weight>" in text
    context, seen = spark.sparkContext, []
    with packing.in_pool(spark, 8):
        seen.append(context.getLocalProperty("spark.scheduler.pool"))
    with packing.in_pool(spark, None):
        seen.append(context.getLocalProperty("spark.scheduler.pool"))
    assert seen == ["tier-8", "default"] and context.getLocalProperty("spark.scheduler.pool") is None


def test_levels_run_jobs_by_size_side_by_side(spark, small, tmp_path):
    names = ["customer", "nation", "region", "supplier"]
    files = lake.segments(spark, small.root).filter(F.col("segment_nm").isin(*names))
    files = files.withColumn("segment_size", F.when(F.col("segment_nm") == "customer", 5 << 30).otherwise(F.col("segment_size")))
    parts = {
        "tables": lake.tables(files), "columns": lake.columns(spark, {n: small[n] for n in names}), "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }

    def run(name, **options):
        store = ResultStore(spark, str(tmp_path / name))
        collect_dictionary(spark, store, "lake", parts, NOW)
        register_population(store, "lake", ["main"], NOW)
        profiler = Profiler(store, lambda _o, tab: small[tab], "lake", decimals=2, clock=lambda: NOW, **options)
        jobs = [[s.spec.tab_nm for s in job] for job in profiler._jobs(None)]
        pools = {s.spec.tab_nm: packing.pool(s.spec.exec_dop) for s in profiler.inputs()}
        profiler.run()
        return jobs, pools, sorted((tuple(r) for r in store.master("column_master").collect()), key=repr)

    by_name, _, due = run("plain", tables_per_job=4)
    by_size, pools, made = run("sized", tables_per_job=2, job_mb=1024, jobs_at_once=3)
    assert by_name == [names]
    assert by_size[0] == ["customer"] and sorted(map(len, by_size)) == [1, 1, 2]
    assert pools["customer"] == "tier-4" and pools["nation"] == "tier-2"
    assert made == due


def test_jobs_beside_a_failing_one_are_noted(spark, small, tmp_path):
    store = ResultStore(spark, str(tmp_path / "store"))
    names = [f"n{i}" for i in range(4)]
    frames = {n: small["nation"] for n in names}
    files = lake.segments(spark, small.root).filter("segment_nm = 'nation'")
    files = files.drop("segment_nm").join(spark.createDataFrame([(n,) for n in names], "segment_nm string")).select(*files.columns)
    parts = {
        "tables": lake.tables(files), "columns": lake.columns(spark, frames), "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }
    collect_dictionary(spark, store, "lake", parts, NOW)
    register_population(store, "lake", ["main"], NOW)
    broken, opened, lock = {"n1"}, [], threading.Lock()

    def read(_o, tab):
        with lock:
            opened.append(tab)
        return frames[tab].withColumn("n_name", F.raise_error(F.lit("lost")).cast("string")) if tab in broken else frames[tab]

    profiler = Profiler(store, read, "lake", tables_per_job=1, jobs_at_once=2, clock=lambda: NOW)
    with pytest.raises(Exception, match="lost"):
        profiler.run_column_level()
    broken.clear()
    opened.clear()
    profiler.run_column_level()
    assert "n1" in opened and "n0" not in opened
    assert {r.notnull_cnt for r in store.master("column_master").collect()} == {25}
    assert math.isfinite(bound())
