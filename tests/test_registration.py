"""Registration rules on small dictionaries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabscope.operators import registration as reg
from tabscope.operators.merge import update_by_key, upsert
from tabscope.operators.ranking import global_row_number
from tabscope.plans.spec import profile_targets, specs_from_masters

T1 = dt.datetime(2026, 1, 1)
T2 = dt.datetime(2026, 2, 2)
MB = 1024 * 1024
KEY = "chasu int, db_nm string, owner_nm string, "


def snapshot(spark, sizes=(("T", 30), ("U", 20), ("V", 10), ("W", 5)), chasu=1, type_of_a="varchar2"):
    make = lambda data, ddl: spark.createDataFrame([(chasu, "db", "A", *row) for row in data], KEY + ddl)
    return reg.Snapshot(
        tables=make([(t, "", "N") for t, _ in sizes], "tab_nm string, tab_comment string, part_yn string"),
        columns=make(
            [("T", "A", "", 1, type_of_a, 10, "N", None, None), ("T", "B", "", 30, "number", 22, "Y", 10, 0)],
            "tab_nm string, col_nm string, col_comment string, col_seq int, data_type string, data_len bigint, "
            "null_yn string, data_precision int, data_scale int",
        ),
        segments=make(
            [(t, "TABLE", mb * MB) for t, mb in sizes] + [("PK_T", "INDEX", 3 * MB)],
            "segment_nm string, segment_type string, segment_size bigint",
        ),
        constraints=make([("PK_T", "P", "T"), ("FK_T", "R", "T")], "cons_nm string, cons_type string, table_nm string"),
        constraint_columns=make([("PK_T", "T", "B", 1), ("FK_T", "T", "A", 1)], "cons_nm string, table_nm string, col_nm string, pos int"),
        indexes=make([("PK_T", "T")], "index_nm string, tab_nm string"),
    )


def empty(spark, types):
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items()))


@pytest.fixture
def masters(spark):
    return reg.register(
        snapshot(spark), empty(spark, reg.TABLE_MASTER), empty(spark, reg.COLUMN_MASTER), "db", T1
    )


def test_parallelism_tiers(spark):
    sizes = [(99, 2), (100, 4), (49999, 4), (50000, 8), (99999, 8), (100000, 16)]
    df = spark.createDataFrame(sizes, "mb bigint, want int")
    assert all(r[0] == r[1] for r in df.select("want", reg.parallelism(F.col("mb"))).collect())


def test_work_groups(masters, rows):
    assert rows(masters[0], "tab_nm", "tab_size", "tab_workgrp_no") == [("T", 30, 2), ("U", 20, 3), ("V", 10, 1), ("W", 5, 2)]


def test_column_work_group(spark):
    df = spark.createDataFrame([(1, 1), (29, 1), (30, 2), (59, 2), (60, 3)], "seq int, want int")
    assert all(r[0] == r[1] for r in df.select("want", reg.column_work_group(F.col("seq"))).collect())


def test_global_row_number_matches_a_window(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3 == 0).alias("hot"))
    numbered = global_row_number(df, [F.desc("hot"), F.asc("k")], "rn").orderBy("rn").collect()
    assert [r.rn for r in numbered] == list(range(1, 5001))
    assert [(not r.hot, r.k) for r in numbered] == sorted((not r.hot, r.k) for r in numbered)


def test_index_stats(spark, rows):
    s = snapshot(spark)
    assert rows(reg.index_stats(s.segments, s.indexes)) == [("A", "PK_T", 0, 3)]
    assert rows(reg.index_stats(s.segments, s.indexes, by_index=True)) == [("A", "T", 1, 3)]


def test_first_registration(masters, rows):
    tables, columns = masters
    assert rows(tables, "tab_nm", "use_yn", "col_cnt", "index_cnt", "up_dt")[0] == ("T", "Y", 2, 0, None)
    assert rows(columns, "col_nm", "pk_col_seq", "colval_exec_typ", "colpat_exec_typ", "col_workgrp_no") == [
        ("A", None, "Y", "Y", 1), ("B", 1, None, None, 2)]


def test_registering_again(spark, masters, rows):
    tables, columns = masters
    tables = tables.withColumns({"use_yn": F.lit("N"), "tab_cnt": F.lit(7).cast("bigint")})
    columns = columns.withColumns(
        {"use_yn": F.lit("N"), "colval_exec_typ": F.lit("B"), "notnull_cnt": F.lit(3).cast("bigint")}
    )
    again = snapshot(spark, (("T", 99), ("NEW", 1)), chasu=2, type_of_a="nchar")
    tables2, columns2 = reg.register(again, tables, columns, "db", T2)
    got = {r.tab_nm: r for r in tables2.collect()}
    assert (got["T"].use_yn, got["T"].tab_cnt, got["T"].tab_size, got["T"].chasu) == ("Y", 7, 99, 2)
    assert (got["T"].cr_dt, got["T"].up_dt) == (T1, T2)
    assert (got["U"].use_yn, got["U"].chasu, got["U"].up_dt) == ("N", 1, None)
    assert (got["NEW"].use_yn, got["NEW"].tab_cnt, got["NEW"].cr_dt, got["NEW"].up_dt) == ("Y", None, T2, None)
    cols = {r.col_nm: r for r in columns2.collect()}
    assert (cols["A"].use_yn, cols["A"].colval_exec_typ, cols["A"].notnull_cnt) == ("N", "B", 3)
    assert (cols["A"].col_data_type, cols["A"].chasu, cols["A"].cr_dt) == ("nchar", 2, T1)
    assert columns2.count() == columns.count()


def test_registering_twice_equals_once(spark, masters):
    tables, columns = reg.register(snapshot(spark), *masters, "db", T2)
    for once, twice in zip(masters, (tables, columns)):
        drop = [c for c in once.columns if c != "up_dt"]
        assert once.select(drop).exceptAll(twice.select(drop)).isEmpty() and once.count() == twice.count()


def test_profiles_share_rows_only_without_profile_key(spark, masters):
    tables, columns = masters
    both = reg.register(snapshot(spark), tables, columns, "db", T2, "P02")
    assert both[0].count() == 2 * tables.count()
    one = reg.register(snapshot(spark), tables, columns, "db", T2, "P02", per_profile=False)
    assert {r.prfl_id for r in one[0].collect()} == {"P02"}
    assert {r.prfl_id for r in one[1].collect()} == {"P01"}


def test_targets_and_specs(spark, masters, rows):
    tables, columns = masters
    off = tables.withColumn("use_yn", F.when(F.col("tab_nm") == "U", "N").otherwise("Y"))
    assert [r.tab_nm for r in profile_targets(off, "db", "P01").collect()] == ["T", "V", "W"]
    flagged = columns.withColumn("colval_exec_typ", F.when(F.col("col_nm") == "B", "B").otherwise(F.col("colval_exec_typ")))
    specs = list(specs_from_masters(off, flagged, "db"))
    assert [s.tab_nm for s in specs] == ["T", "V", "W"]
    assert [(c.col_nm, c.value_mode, c.pattern, c.vendor_type) for c in specs[0].columns] == [
        ("A", "Y", True, "varchar2"), ("B", "B", False, "number")]
    assert specs[1].columns == ()


def test_update_takes_null_and_leaves_the_rest(spark, rows):
    master = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, other string")
    facts = spark.createDataFrame([("a", None), ("z", 9)], "k string, v int")
    assert rows(update_by_key(master, facts, ["k"], ["v"])) == [("a", None, "x"), ("b", 2, "y")]


def test_upsert_rules(spark, rows):
    old = spark.createDataFrame([("a", 1, 1, "o"), ("b", 2, 2, "o")], "k string, fresh int, kept int, mark string")
    new = spark.createDataFrame([("b", 9, 9), ("c", 8, 8)], "k string, fresh int, kept int")
    got = rows(upsert(old, new, ["k"], ["fresh"], {"mark": F.lit("hit")}))
    assert got == [("a", 1, 1, "o"), ("b", 9, 2, "hit"), ("c", 8, 8, None)]


def test_nothing_moves_to_meet_a_master_without_rows(spark, tmp_path, rows):
    from tabscope.sources.store import ResultStore

    master = ResultStore(spark, str(tmp_path)).master("column_master")
    incoming = reg.column_population(snapshot(spark), T1)
    made = reg.upsert_columns(master, incoming, T1)
    assert made.columns == master.columns
    assert rows(made) == rows(incoming.select(*master.columns))
    joins = [f._jdf.queryExecution().optimizedPlan().toString().count("Join") for f in (made, incoming)]
    assert joins[0] == joins[1]


def test_joins_sort_by_the_table_before_its_owner(spark):
    """Owners are few: rows sorted by them first are compared whole, most of all for a full key."""
    s = snapshot(spark)
    for made in (reg.table_population(s, T1), reg.column_population(s, T1)):
        text = made._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in text.splitlines() if "Join" in line and "tab_nm#" in line]
        assert joins and all(line.index("tab_nm#") < line.index("owner_nm#") for line in joins)
