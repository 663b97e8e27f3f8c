"""Bounded top values, lakes of other formats and partitions, row-level merges."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.operators.dictionary import lake
from tabscope.operators.heavy import heaviest, sample_values_bounded, top_pattern_bounded
from tabscope.operators.merge import merge_update, merge_upsert
from tabscope.operators.pattern_dist import pattern_counts_direct, top_pattern
from tabscope.operators.value_dist import sample_values, value_histogram
from tabscope.sources.registry import SourceRegistry
from verification.inputs import inputs


@pytest.mark.parametrize("limits", [{}, {"buckets": 4, "exact_buckets": 1}, {"buckets": 64, "exact_buckets": 2}])
def test_bounded_samples_equal_the_histogram(small, rows, limits):
    sources = inputs(small, "customer", "orders", "events", "documents", "pages")
    due = sample_values(value_histogram(sources))
    assert rows(sample_values_bounded(sources, limits=limits), *due.columns) == rows(due)
    due = top_pattern(pattern_counts_direct(sources))
    assert rows(top_pattern_bounded(sources, limits=limits), *due.columns) == rows(due)


def values(spark, **columns):
    data = [(ref, v) for ref, vs in columns.items() for v in vs]
    return spark.createDataFrame(data, "ref string, value string")


def test_what_is_proven(spark):
    frame = values(
        spark,
        skewed=["a"] * 900 + ["b"] * 500 + ["c"] * 300 + [f"x{i}" for i in range(1000)],
        unique=[f"u{i}" for i in range(3000)],
        few=["p", "q"],
        ties=[f"t{i % 200}" for i in range(2000)],
    )
    found, refs = heaviest(frame, 4, 3, buckets=256, exact_buckets=8)
    assert set(refs) == {"few", "skewed"}
    made = {(r.ref, r.value): r.n for r in found.collect()}
    assert [made["skewed", v] for v in "abc"] == [900, 500, 300]
    assert made["few", "p"] == made["few", "q"] == 1
    assert heaviest(frame.where("false"), 4, 3)[1] == []


def test_the_summary_is_bounded(spark):
    frame = spark.range(20_000).select(F.lit("r").alias("ref"), F.col("id").cast("string").alias("value"))
    found, refs = heaviest(frame, 1, 3, buckets=128, exact_buckets=2)
    assert refs == [] and found.count() <= 3


def test_partitions_become_segments(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x y", "a/b"), (2, "é", "c+d"), (3, None, "a/b")], "k int, p string, q string")
    frame.write.partitionBy("p", "q").parquet(str(tmp_path / "lake" / "t"))
    frame.coalesce(1).write.json(str(tmp_path / "lake" / "plain"))
    (tmp_path / "lake" / "single.csv").write_text("1,2\n")
    found = lake.partition_segments(spark, str(tmp_path / "lake")).collect()
    made = {(r.segment_nm, r.partition_nm): r for r in found}
    assert set(made) == {
        ("t", "p=x y/q=a/b"), ("t", "p=é/q=c+d"), ("t", "p=__HIVE_DEFAULT_PARTITION__/q=a/b"),
        ("plain", "NOPART"), ("single", "NOPART"),
    }
    assert made["single", "NOPART"].segment_size == 4 and made["single", "NOPART"].block_cnt == 1
    tables = {r.tab_nm: r.part_yn for r in lake.tables(lake.partition_segments(spark, str(tmp_path / "lake"))).collect()}
    assert tables == {"t": "Y", "plain": "N", "single": "N"}
    assert lake.partition_segments(spark, str(tmp_path / "lake"), suffix=".csv").count() == 1


def test_text_files_are_read_with_their_schema(spark, tmp_path, small):
    sources = SourceRegistry(spark)
    small["nation"].write.csv(str(tmp_path / "nation.csv"), header=True)
    sources.register_files("csv", str(tmp_path), "csv", {"nation": small["nation"].schema}, header="true")
    assert sources.table("csv", "nation").schema == T.StructType(small["nation"].schema.fields)
    assert sources.table("csv", "nation").count() == 25


class Recorded:
    """Stands for Spark's writer: what the statement was built of."""

    def __init__(self, source, table, condition):
        self.steps = [("into", source.columns, table, str(condition))]

    def whenMatched(self):
        self.steps.append("matched")
        return self

    def whenNotMatched(self):
        self.steps.append("not matched")
        return self

    def update(self, assignments):
        self.steps.append(("update", {k: str(v) for k, v in assignments.items()}))
        return self

    def insert(self, assignments):
        self.steps.append(("insert", {k: str(v) for k, v in assignments.items()}))
        return self


@pytest.fixture
def recorded(spark, monkeypatch):
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "mergeInto", lambda self, table, condition: Recorded(self, table, condition))


SAME = "Column<'and(and(true, =(target.db_nm, source.db_nm)), =(target.tab_nm, source.tab_nm))'>"


def test_update_as_merge_into(spark, recorded):
    facts = spark.createDataFrame([("d", "t", 5, "x")], "db_nm string, tab_nm string, tab_cnt long, other string")
    stamp = F.lit("now")
    made = merge_update("cat.db.master", facts, ["db_nm", "tab_nm"], ["tab_cnt"], stamp)
    assert made.steps == [
        ("into", ["db_nm", "tab_nm", "tab_cnt"], "cat.db.master", SAME),
        "matched",
        ("update", {"tab_cnt": "Column<'source.tab_cnt'>", "up_dt": "Column<''now''>"}),
    ]


def test_upsert_as_merge_into(spark, recorded):
    """Refreshed columns from the source, given ones by their rule, all others kept."""
    incoming = spark.createDataFrame([("d", "t", "c", 1)], "db_nm string, tab_nm string, tab_comment string, chasu int")
    columns = ["db_nm", "tab_nm", "tab_comment", "chasu", "use_yn", "cr_dt", "up_dt"]
    made = merge_upsert(
        "master", incoming, ["db_nm", "tab_nm"], ["tab_comment", "chasu"],
        {"use_yn": F.lit("Y"), "up_dt": F.lit("now")}, columns,
    )
    own = {c: f"Column<'source.{c}'>" for c in incoming.columns}
    assert made.steps == [
        ("into", incoming.columns, "master", SAME),
        "matched",
        ("update", {"tab_comment": own["tab_comment"], "chasu": own["chasu"], "use_yn": "Column<''Y''>", "up_dt": "Column<''now''>"}),
        "not matched",
        ("insert", {**own, "use_yn": "Column<'NULL'>", "cr_dt": "Column<'NULL'>", "up_dt": "Column<'NULL'>"}),
    ]


def test_a_merge_is_one_statement_of_spark(spark):
    """Without a table format that changes rows the default stays the join."""
    incoming = spark.createDataFrame([("d", "t", 1)], "db_nm string, tab_nm string, chasu int")
    writer = merge_upsert("nowhere.master", incoming, ["db_nm", "tab_nm"], ["chasu"], columns=["db_nm", "tab_nm", "chasu"])
    with pytest.raises(Exception):
        writer.merge()
