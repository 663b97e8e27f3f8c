"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from tabscope.operators import column_stats as column_stats_module
from tabscope.operators.column_stats import _distinct, _plain_text, column_numbers, column_stats
from tabscope.operators.pattern_dist import patterns_direct, patterns_from_values
from tabscope.operators.report import profile_report
from tabscope.operators.table_stats import row_counts
from tabscope.operators.value_dist import sample_values, value_histogram
from verification.catalogs import extract
from verification.inputs import inputs, profile_input

MODES = {"l_returnflag": "Y", "l_shipdate": "A", "l_extendedprice": "B", "l_tax": "B"}


def plan(df, executed=False):
    if executed:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if executed else text


def count(pattern, text):
    return len(re.findall(pattern, text))


@pytest.fixture(scope="module")
def line(small):
    return [profile_input(small["lineitem"], "lineitem", MODES)]


def no_python(text):
    assert "Python" not in text and "MapInPandas" not in text and "ArrowEval" not in text


def test_histogram_is_one_scan_and_one_shuffle(line):
    text = plan(value_histogram(line))
    assert count("FileScan", text) == 1 and count("Exchange", text) == 1
    assert "SortAggregate" not in text and count("HashAggregate", text) == 2
    assert "ReadSchema: struct<l_extendedprice:double,l_tax:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text
    no_python(text)


def test_histograms_of_many_tables_share_one_shuffle(small):
    text = plan(value_histogram(inputs(small, "orders", "customer", "events")))
    assert count("FileScan", text) == 3 and count("Exchange", text) == 1


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def test_plain_text_statistics_neither_expand_rows_nor_sort(small):
    text = plan(_plain_text(column_numbers([text_only(small)]), 18, 256))
    below = text[text.index("SortAggregate"):]
    assert "Expand" not in below and not re.search(r"\bSort \[", below)
    assert count("FileScan", text) == 1 and count("Exchange SinglePartition", text) == 1


def text_only(small):
    return profile_input(small["lineitem"].select("l_returnflag", "l_linestatus"), "lineitem")


def test_distinct_counts_are_hash_aggregation_over_disjoint_columns(small):
    text = plan(_distinct(column_numbers(inputs(small, "lineitem"))))
    assert "SortAggregate" not in text and "BroadcastNestedLoop" not in text
    read = read_columns(text)
    assert sum(map(len, read)) == len(set.union(*read)) == 11


@pytest.fixture
def first_pass(monkeypatch):
    """Plans of the passes over text that run while the statistics are put together."""
    plans = []
    make = column_stats_module._plain_text

    def watched(*args):
        frame = make(*args)
        plans.append(plan(frame))
        return frame

    monkeypatch.setattr(column_stats_module, "_plain_text", watched)
    return plans


def test_statistics_read_text_twice_and_everything_else_once(small, first_pass, monkeypatch):
    """Whole extremes that are shorter than the leading characters take no third pass."""
    monkeypatch.setattr(column_stats_module, "_whole_extremes", None)
    text = plan(column_stats(inputs(small, "lineitem")))
    read = [c for p in (text, *first_pass) for columns in read_columns(p) for c in columns]
    twice = {c for c in read if read.count(c) > 1}
    assert twice == {"l_returnflag", "l_linestatus"} and len(set(read)) == 11
    assert all(read.count(c) == 2 for c in twice)
    no_python(text)


def test_only_columns_with_long_extremes_are_read_again(small, first_pass):
    frame = small["nation"].select(
        "n_name", F.repeat("n_name", 60).alias("high"), F.concat(F.lit("x"), "n_name").alias("short")
    )
    text = plan(column_stats([profile_input(frame, "nation")]))
    assert count("FileScan", text) == 2 and len(first_pass) == 1  # distinct counts, long ones
    made = {r.col_nm: r for r in column_stats([profile_input(frame, "nation")]).collect()}
    names = [r.n_name for r in small["nation"].collect()]
    assert made["high"].max_col_val == max(n * 60 for n in names)
    assert made["high"].min_col_val == min(n * 60 for n in names)
    assert (made["n_name"].max_col_val, made["short"].min_col_val) == (max(names), "x" + min(names))


def test_numbers_of_all_types_share_an_aggregate(small):
    numbers = small["lineitem"].drop("l_returnflag", "l_linestatus")
    text = plan(column_stats([profile_input(numbers, "lineitem")]))
    assert count("Exchange SinglePartition", text) == 1


def test_statistics_of_numbers_do_not_sort(small):
    """Rows are combined by value on the map side; extremes of the values need no sort."""
    numbers = small["lineitem"].select("l_orderkey", "l_partkey")
    text = plan(column_stats([profile_input(numbers, "lineitem")], extreme_chars=4000))
    assert "Sort [" not in text
    assert count(r"HashAggregate\(keys=\[ref", text) == 2


def test_extremes_are_cut_before_they_are_exchanged(small, first_pass):
    """A task sends leading characters only, also where extremes are wanted whole."""
    for chars, width in ((4000, 4000), (None, 256)):
        plan(column_stats([text_only(small)], extreme_chars=chars))
        text = first_pass[-1]
        partial = [line for line in text.splitlines() if "partial_max(substring" in line]
        assert partial and all(f"1, {width}" in line for line in partial)
        assert "partial_max(l_returnflag" not in text


def test_row_counts_read_no_column(small):
    text = plan(row_counts(inputs(small, "lineitem", "orders")))
    assert count(r"ReadSchema: struct<>", text) == 2


def test_direct_patterns_scan_once(small):
    text = plan(patterns_direct(inputs(small, "customer")), executed=True)
    assert count("FileScan", text) == 1 and "ReusedExchange" in text
    assert "Window" not in text
    no_python(text)


@pytest.mark.parametrize("columns", [None, 2])
def test_shares_of_values_read_the_tables_once(small, columns):
    histogram = value_histogram(inputs(small, "customer"))
    text = plan(patterns_from_values(histogram, columns=columns), executed=True)
    assert count("FileScan", text) == 1 and "ReusedExchange" in text
    assert text.count("translate(") <= 4 and "xxhash64(CASE" not in text


def test_samples_limit_before_the_shuffle(line):
    text = plan(sample_values(value_histogram(line)))
    assert count("WindowGroupLimit", text) == 2
    last_exchange = text.index("Exchange")
    assert "Partial" in text[last_exchange:].split("HashAggregate")[0]


def test_report_has_no_cross_join_and_no_python(small):
    text = plan(profile_report(inputs(small, "orders", "customer")))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    no_python(text)


def test_report_reads_each_table_once_per_level(small):
    """A pass per key type over its own columns, the plain text pass, one histogram."""
    texts = {"c_name", "c_mktsegment"}
    for chars, passes in ((4000, 3), (None, 2)):  # for whole extremes the plain pass ran before
        text = plan(profile_report(inputs(small, "customer"), extreme_chars=chars), executed=True)
        expected = [{"c_custkey", "c_nationkey"}, {"c_acctbal"}, *[texts] * passes]
        assert sorted(map(sorted, read_columns(text))) == sorted(map(sorted, expected))


def test_column_stats_join_is_over_columns_only(small):
    text = plan(column_stats(inputs(small, "orders"), extreme_chars=4000))
    assert count("BroadcastHashJoin", text) == 2 and "SortMergeJoin" not in text


def test_snapshot_filter_prunes_partitions(spark, small, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    from tabscope.operators.dictionary import lake
    from tabscope.pipeline import collect_dictionary
    from tabscope.sources.store import ResultStore

    store = ResultStore(spark, str(tmp_path))
    parts = {"columns": lake.columns(spark, small)}
    for chasu in (1, 2):
        collect_dictionary(spark, store, "lake", parts, dt.datetime(2026, 1, 1), chasu)
    text = plan(store.read("dic_columns").filter((F.col("db_nm") == "lake") & (F.col("chasu") == 2)))
    assert re.search(r"PartitionFilters: \[.*chasu.*\]", text)


def test_file_segments_read_no_content(spark, small):
    from tabscope.operators.dictionary import lake

    text = plan(lake.segments(spark, small.root))
    assert "content" not in text


def test_derived_catalogs_prune_columns(small):
    text = plan(extract(small, "all_views"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in text
