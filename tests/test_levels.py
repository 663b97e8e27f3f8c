"""The profile levels: invariants, equal strategies, edge cases."""

import pytest
from pyspark.sql import functions as F

from tabscope.operators.column_stats import column_stats, distinct_counts
from tabscope.operators.pattern_dist import patterns_direct, patterns_from_values, top_pattern, with_share
from tabscope.operators.report import profile_report
from tabscope.operators.table_stats import row_counts
from tabscope.operators.value_dist import sample_values, value_histogram
from tabscope.plans.spec import (
    COLUMN_KEY,
    ColumnSpec,
    ProfileInput,
    TableSpec,
    spec_from_schema,
)
from verification.inputs import inputs, profile_input

MODES = {"o_orderstatus": "Y", "o_orderpriority": "Y", "o_orderdate": "A", "o_totalprice": "B"}


def make(spark, data, ddl, modes=None):
    frame = spark.createDataFrame(data, ddl)
    return ProfileInput(spec_from_schema(frame, "t", modes=modes), frame)


@pytest.fixture(scope="module")
def holed(small):
    """Orders in which some values are NULL."""
    frame = small["orders"].select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"),
    )
    return profile_input(frame, "orders")


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_three_strategies_agree(small):
    source = [profile_input(small["orders"], "orders", MODES)]
    plain = value_histogram(source)
    assert same(plain, value_histogram(source, strategy="joint"))
    assert same(plain, value_histogram(source, strategy="per_column"))
    with pytest.raises(ValueError):
        value_histogram(source, strategy="other")


def test_two_phase_patterns_agree(small):
    source = inputs(small, "events", "customer")
    assert same(patterns_direct(source), patterns_direct(source, two_phase=True))


def test_counts_add_up(holed):
    total = row_counts([holed]).first()["tab_cnt"]
    stats = {r.col_nm: r for r in column_stats([holed]).collect()}
    values = value_histogram([holed])
    sums = {r.col_nm: r.n for r in values.groupBy("col_nm").agg(F.sum("col_val_cnt").alias("n")).collect()}
    nulls = {r.col_nm: r.col_val_cnt for r in values.filter("col_val = '##'").collect()}
    patterns = patterns_direct([holed])
    shown = {
        r.col_nm: (r.n, float(r.share))
        for r in patterns.groupBy("col_nm").agg(
            F.sum("col_pat_cnt").alias("n"), F.sum(F.col("col_pat_rt").cast("double")).alias("share")
        ).collect()
    }
    for name in ("o_orderstatus", "o_orderpriority"):
        assert sums[name] == total
        assert nulls[name] == total - stats[name].notnull_cnt > 0
        assert shown[name][0] == stats[name].notnull_cnt
        assert abs(shown[name][1] - 100) < 0.1


def test_column_stats_by_hand(spark):
    source = make(
        spark,
        [(9, "b", None, 1.5), (10, "a", None, -0.0), (10, None, None, 0.0)],
        "n int, s string, empty string, d double",
    )
    got = {r.col_nm: r for r in column_stats([source]).collect()}
    n = got["n"]
    assert (n.notnull_cnt, n.col_kind, n.max_col_val, n.min_col_val, n.max_len) == (3, 2, "9", "10", 2)
    assert (got["s"].notnull_cnt, got["s"].col_kind) == (2, 2)
    e = got["empty"]
    assert (e.notnull_cnt, e.col_kind, e.max_col_val, e.max_len) == (0, 0, None, 0)
    assert got["d"].col_kind == 2


def test_extremes_are_whole_unless_a_width_is_given(spark):
    source = make(spark, [("x" * 5000,), ("x" * 4500 + "y",), (None,), ("x" * 4500,)], "s string")
    row = column_stats([source]).first()
    assert (row.max_col_val, row.min_col_val, row.max_len) == ("x" * 4500 + "y", "x" * 4500, 5000)
    row = column_stats([source], extreme_chars=4000).first()
    assert (len(row.max_col_val), len(row.min_col_val), row.max_len) == (4000, 4000, 5000)


def test_whole_extremes_of_short_empty_and_missing_texts(spark):
    source = make(spark, [("b", None, ""), ("a", None, "z" * 300), (None, None, "z" * 299 + "é")], "s string, n string, e string")
    got = {r.col_nm: (r.max_col_val, r.min_col_val) for r in column_stats([source]).collect()}
    assert got == {"s": ("b", "a"), "n": (None, None), "e": ("z" * 299 + "é", "")}


def test_a_table_without_rows_still_has_its_columns(spark):
    source = make(spark, [], "n int, s string, d double")
    got = {tuple(r)[3:] for r in column_stats([source], with_row_count=True).drop("prfl_id").collect()}
    assert got == {(c, 0, 0, None, None, 0, 0) for c in ("n", "s", "d")}
    with pytest.raises(ValueError):
        column_stats([make(spark, [], "a array<int>")])


def test_statistics_over_several_key_types_and_tables(spark):
    one = make(spark, [(1, 1.25, True), (None, 1.25, None)], "a int, b double, c boolean")
    frame = spark.createDataFrame([(7, 2.5)], "a bigint, b double")
    two = ProfileInput(spec_from_schema(frame, "u", decimals=2), frame)
    got = {(r.tab_nm, r.col_nm): (r.notnull_cnt, r.col_kind, r.max_col_val) for r in column_stats([one, two]).collect()}
    assert got == {
        ("t", "a"): (1, 1, "1"), ("t", "b"): (2, 1, "1.25"), ("t", "c"): (1, 1, "true"),
        ("u", "a"): (1, 1, "7"), ("u", "b"): (1, 1, "2.50"),
    }


def test_column_batches_change_nothing(small):
    source = inputs(small, "orders", "part")
    assert same(column_stats(source), column_stats(source, batch_columns=1))


def test_unstructured_columns_vanish(small):
    assert {r.col_nm for r in column_stats(inputs(small, "embeddings")).collect()} == {"vec_id", "label"}


def test_wide_tables_are_cut_into_runs(spark):
    frame = spark.range(50).select(*[(F.col("id") % (i + 1)).cast("string").alias(f"c{i}") for i in range(200)])
    source = [ProfileInput(spec_from_schema(frame, "wide"), frame)]
    kinds = {r.col_nm: r.col_kind for r in distinct_counts(source).collect()}
    assert kinds == {f"c{i}": min(i + 1, 50) for i in range(200)}
    assert value_histogram(source).groupBy("col_nm").count().count() == 200


def test_all_plain_types(spark):
    frame = spark.sql(
        "SELECT TRUE AS b, DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 03:04:05.5' AS t, "
        "TIMESTAMP_NTZ'2024-01-02 03:04:05' AS z, CAST(1.50 AS DECIMAL(10,2)) AS m, "
        "CAST(2 AS TINYINT) AS y, CAST(1.5 AS FLOAT) AS f, X'00' AS raw, MAP(1, 2) AS mp"
    )
    got = {r.col_nm: (r.max_col_val, r.col_kind) for r in column_stats([ProfileInput(spec_from_schema(frame, "t"), frame)]).collect()}
    assert got == {
        "b": ("true", 1), "d": ("2024-01-02", 1), "t": ("2024-01-02 03:04:05.5", 1),
        "z": ("2024-01-02 03:04:05", 1), "m": ("1.50", 1), "y": ("2", 1), "f": ("1.5", 1),
    }


def test_column_selection(spark):
    frame = spark.createDataFrame([("a", "b", "c", "d")], "y string, off string, none string, lob string")
    columns = (
        ColumnSpec("y", "Y", True), ColumnSpec("off", "Y", True, use=False),
        ColumnSpec("none", None, False), ColumnSpec("lob", "Y", True, vendor_type="clob"),
    )
    source = ProfileInput(TableSpec("d", "o", "t", columns), frame)
    assert [c.col_nm for c in source.stat_columns()] == ["y", "none"]
    assert [c.col_nm for c in source.value_columns()] == ["y"]
    assert [c.col_nm for c in source.pattern_columns()] == ["y"]


def test_odd_column_names(spark):
    source = make(spark, [("v", 1)], "`a.b` string, `c``d e` int")
    assert {r.col_nm for r in column_stats([source]).collect()} == {"a.b", "c`d e"}
    assert value_histogram([source]).first().col_nm == "a.b"


def histogram(spark, pairs):
    return spark.createDataFrame(
        [("d", "o", "t", "c", "P01", v, n) for v, n in pairs],
        ", ".join(f"{k} string" for k in COLUMN_KEY) + ", col_val string, col_val_cnt bigint",
    )


def test_samples(spark):
    h = histogram(spark, [("y", 9), ("a", 5), ("x", 5), ("q", 1), ("##", 50)])
    assert sample_values(h).first().sample_data == "y | a | x"


def test_patterns_of_values(spark):
    h = histogram(spark, [("1~100", 2), ("##", 50), ("101~1000", 1)])
    got = {r.col_pat: (r.col_pat_cnt, r.col_pat_rt) for r in patterns_from_values(h).collect()}
    assert got == {"C$CCC": (2, "66.67"), "CCC$CCCC": (1, "33.33")}
    assert same(patterns_from_values(h), patterns_from_values(h, columns=1))


def test_top_pattern_prefers_the_smaller_on_a_tie(spark):
    h = histogram(spark, [("b1", 3), ("bb", 3), ("B", 1)]).withColumnsRenamed({"col_val": "col_pat", "col_val_cnt": "col_pat_cnt"})
    assert top_pattern(h).first().top_col_pat == "b1"


def test_share_join_survives_a_hot_column(spark):
    """One column with many patterns; the salted and the broadcast path agree."""
    h = spark.range(20000).select(
        F.when(F.col("id") < 19000, "hot").otherwise("cold").alias("ref"),
        F.col("id").cast("string").alias("col_pat"),
        (F.col("id") + 1).alias("col_pat_cnt"),
    )
    assert same(with_share(h, ["ref"]), with_share(h, ["ref"], columns=2))


def test_report_levels(small):
    source = inputs(small, "nation")
    assert "sample_data" not in profile_report(source, levels=()).columns
    direct = profile_report(source, pattern_source="direct")
    assert same(direct, profile_report(source))
    numbers = profile_report(inputs(small, "labels"))
    assert numbers.count() == 3


def test_integers_are_reduced_to_a_row_per_length(spark):
    """What is asked about for every column are sign and length groups, not values."""
    values = [-(2**63), 2**63 - 1, -10, -9, -100, 0, 9, 10, 100, 9, None]
    names = [f"c{i}" for i in range(40)]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint").select(
        *[F.col("v").alias(n) for n in names], F.lit(None).cast("int").alias("empty")
    )
    stats = column_stats([profile_input(frame, "t")], with_row_count=True)
    assert "HashAggregate(keys=[of#" in stats._jdf.queryExecution().executedPlan().toString()
    found = {r.col_nm: r for r in stats.collect()}
    texts = [str(v) for v in values if v is not None]
    for name in names:
        r = found[name]
        assert (r.tab_cnt, r.notnull_cnt, r.col_kind) == (11, 10, 9)
        assert (r.max_col_val, r.min_col_val, r.max_len) == (max(texts), min(texts), 20)
    r = found["empty"]
    assert (r.tab_cnt, r.notnull_cnt, r.col_kind, r.max_col_val, r.max_len) == (11, 0, 0, None, 0)


def test_a_batch_reads_the_types_of_its_own_columns(spark):
    columns = [f"id * 0.5D AS d{i}" for i in range(3)] + ["date_add(DATE '2024-01-01', CAST(id AS INT)) AS day"]
    frame = spark.range(20).selectExpr(*columns)
    stats = column_stats([profile_input(frame, "t")], batch_columns=3)
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 20") == 2
    found = {r.col_nm: (r.max_col_val, r.min_col_val, r.col_kind) for r in stats.collect()}
    assert found["day"] == ("2024-01-20", "2024-01-01", 20)
    assert {v[2] for v in found.values()} == {20} and len(found) == 4
    assert {float(found[f"d{i}"][0]) for i in range(3)} == {float(max(f"{i / 2:.2f}" for i in range(20)))}
