"""Text forms, buckets and patterns against hand-computed values."""

import math
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.buckets import range_label, value_bucket
from tabscope.functions.patterns import char_pattern
from tabscope.functions.text import canonical_text, distinct_key
from tabscope.functions.types import character_type_name, is_unstructured
from tabscope.operators.pattern_dist import share_text

PATTERNS = [
    ("AB12 x.y", "CCCC#c*c", "CCNN#c*c"),
    ("홍길동-1", "가가가$C", "가가가$N"),
    ("#*N", "#*C", "#*C"),
    ("é😀\n", "$$$", "$$$"),
    ("", "", ""),
    ("ㄱ힣a가$", "$가c가$", "$가c가$"),
    ("\x00\t~", "$$$", "$$$"),
    (None, None, None),
]


@pytest.mark.parametrize("mode, at", [("executed", 1), ("documented", 2)])
def test_patterns(spark, mode, at):
    df = spark.createDataFrame([(p[0], p[at]) for p in PATTERNS], "t string, want string")
    got = df.select("want", char_pattern(F.col("t"), mode).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_pattern_mode_is_checked():
    with pytest.raises(ValueError):
        char_pattern(F.lit("a"), "other")


def _chain(text, mode):
    """The class rules applied one after the other, in plain Python."""
    import re

    first = [("[0-9]", "N"), ("[A-Z]", "C")]
    if mode == "documented":
        first.reverse()
    tail = [("[a-z]", "c"), ("[가-힣]", "가"), ("[.]", "*"), (" ", "#"), ("[^NCc가*#]", "$")]
    for rule, symbol in first + tail:
        text = re.sub(rule, symbol, text)
    return text


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30).filter(lambda s: s.isprintable()), min_size=1, max_size=40))
def test_patterns_equal_the_rule_chain(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(
        "t", *[char_pattern(F.col("t"), m).alias(m) for m in ("executed", "documented")]
    ).collect()
    for r in got:
        assert r.executed == _chain(r.t, "executed")
        assert r.documented == _chain(r.t, "documented")


RANGES = [
    (None, "##"), (0.0, "0"), (1.0, "1~100"), (100.0, "1~100"), (100.5, "1000000초과"),
    (101.0, "101~1000"), (1001.0, "1001~10000"), (10001.0, "10001~100000"),
    (1000000.0, "100001~1000000"), (1000001.0, "1000000초과"), (-0.5, "0미만"),
    (0.5, "1000000초과"), (float("nan"), "1000000초과"), (float("-inf"), "0미만"),
]


def test_range_labels(spark):
    df = spark.createDataFrame(RANGES, "v double, want string")
    assert all(r.want == r.got for r in df.select("want", range_label(F.col("v")).alias("got")).collect())


def test_rounded_range_labels(spark):
    df = spark.createDataFrame([(0.4, "0"), (0.5, "1~100"), (100.4, "1~100"), (-0.4, "0")], "v double, want string")
    got = df.select("want", range_label(F.col("v"), rounded=True).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_prefix_and_month_buckets(spark):
    df = spark.sql("SELECT DATE'2024-01-01' AS d UNION ALL SELECT CAST(NULL AS DATE)")
    got = df.select(
        value_bucket(F.col("d"), T.DateType(), "A").alias("text"),
        value_bucket(F.col("d"), T.DateType(), "A", months=True).alias("month"),
    ).collect()
    assert sorted((r.text, r.month) for r in got) == [("##", "##"), ("2024-0", "202401")]


def test_range_mode_on_text_falls_back_to_the_prefix(spark):
    df = spark.createDataFrame([("ECONOMY",)], "t string")
    assert df.select(value_bucket(F.col("t"), T.StringType(), "B")).first()[0] == "ECONOM"


def test_values_are_whole_unless_a_width_is_given(spark):
    df = spark.createDataFrame([("x" * 150,)], "t string")
    cut, whole = df.select(
        F.length(value_bucket(F.col("t"), T.StringType(), "Y", value_chars=100)),
        F.length(value_bucket(F.col("t"), T.StringType(), "Y")),
    ).first()
    assert (cut, whole) == (100, 150)
    with pytest.raises(ValueError):
        value_bucket(F.col("t"), T.StringType(), "Z")


def test_text_of_numbers(spark):
    df = spark.createDataFrame([(1e7,), (12345678.9,), (float("nan"),), (1e300,)], "v double")
    got = [r[0] for r in df.select(canonical_text(F.col("v"), T.DoubleType(), 2)).collect()]
    assert got == ["10000000.00", "12345678.90", "NaN", "1.0E300"]


def test_distinct_keys_fold_only_equal_values(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (math.nan,), (-math.nan,), (0.1 + 0.2,), (0.3,)], "v double")
    family, key = distinct_key(F.col("v"), T.DoubleType())
    assert family == "double"
    assert df.select(key.alias("k")).distinct().count() == 4
    long_a, long_b = "a" * 70 + "1", "a" * 70 + "2"
    df = spark.createDataFrame([(long_a,), (long_b,), (long_a,), ("a",)], "t string")
    assert df.select(distinct_key(F.col("t"), T.StringType())[1].alias("k")).distinct().count() == 3


def test_type_classes(spark):
    assert is_unstructured(T.ArrayType(T.FloatType()))
    assert is_unstructured(T.StringType(), "clob") and not is_unstructured(T.StringType(), "CLOB2")
    df = spark.createDataFrame([("varchar2", True), ("number", False), ("string", True), ("nchar", True), ("strings", False)], "t string, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", character_type_name(F.col("t"))).collect())


def test_share_text(spark):
    cases = [(1, 3, "33.33"), (3, 3, "100.00"), (1, 800, "0.13"), (0, 5, "0.00"), (0, 0, None), (1, 8, "12.50")]
    df = spark.createDataFrame(cases, "n bigint, total bigint, want string")
    got = df.select("want", share_text(F.col("n"), F.col("total")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 10**12), min_size=1, max_size=30))
def test_share_is_rounded_half_up(spark, counts):
    total = sum(counts)
    df = spark.createDataFrame([(c, total) for c in counts], "n bigint, total bigint")
    got = [Decimal(r[0]) for r in df.select(share_text(F.col("n"), F.col("total"))).collect()]
    want = [
        (Decimal(c) * 100 / Decimal(total)).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
        for c in counts
    ]
    assert got == want
