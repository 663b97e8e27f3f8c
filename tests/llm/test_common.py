"""Helpers the operators share."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabscope.llm import common, decontamination, simhash, toxicity


def test_rows_are_told_apart_exactly(spark, tmp_path):
    path = str(tmp_path / "a b é")
    spark.range(5000).repartition(7).write.parquet(path)
    frame = common.identified(spark.read.parquet(path), "row")
    numbers = {r.id: r.row for r in frame.collect()}
    assert len(set(numbers.values())) == 5000
    assert numbers == {r.id: r.row for r in frame.orderBy(F.desc("id")).collect()}
    made = common.identified(spark.range(10).withColumn("x", F.lit(1)), "row")
    assert made.select("row").distinct().count() == 10


def test_files_that_would_meet_get_another_seed(monkeypatch):
    monkeypatch.setattr(common, "ROW_BITS", 58)  # six bits for files
    paths = [f"file:///x/{i}" for i in range(12)]
    seed = common._apart(paths)
    assert seed == common._apart([p.replace("///", "/") for p in paths])
    with pytest.raises(RuntimeError):
        common._apart([f"hdfs://x/{i}" for i in range(65)])


def test_a_file_with_too_many_rows_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "ROW_BITS", 3)
    spark.range(9).coalesce(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="more than 2"):
        common.identified(spark.read.parquet(str(tmp_path / "t")), "row").collect()


def test_content_order_is_one_of_values(spark):
    schema = "doc_id long, text string, n int, tags array<string>"
    rows = [(1, None, 2, None), (None, "1", 2, None), (1, "", 2, ["a"]), (1, None, None, None)]
    frame = spark.createDataFrame(rows + rows, schema)
    first, second = common.content_order(frame, 1)
    found = frame.select(first.alias("a"), second.alias("b")).collect()
    assert len({r.a for r in found}) == len({r.b for r in found}) == 4
    assert len({(r.a, r.b) for r in found}) == 4


@pytest.mark.parametrize("stage", ["toxic", "copies", "leaks"])
def test_stages_leave_names_like_their_own_alone(spark, documents, labels, stage):
    frame = documents.limit(80).withColumn("_tabscope_row", F.col("doc_id") * 2).withColumn("_tabscope_toxicity", F.lit("mine"))
    made = {
        "toxic": lambda: toxicity.without_toxic(frame, labels),
        "copies": lambda: simhash.one_of_each(frame),
        "leaks": lambda: decontamination.without_contaminated(frame, spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string")),
    }[stage]()
    assert made.columns == frame.columns
    rows = made.collect()
    assert rows and all(r._tabscope_row == 2 * r.doc_id and r._tabscope_toxicity == "mine" for r in rows)


def test_batches_are_bounded_by_bytes_too(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    long = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("abcdefghij"), 300_000).alias("text"))
    made = common.map_batches(long, sizes, "n long, size long").collect()
    assert sum(r.n for r in made) == 40
    assert max(r.size for r in made) < common.BATCH_BYTES + 4_000_000
    many = common.map_batches(spark.range(0, 2000, 1, 1), sizes, "n long, size long").collect()
    assert max(r.n for r in many) == common.BATCH_ROWS


@pytest.mark.parametrize("text, size", [("67108864b", 64 << 20), ("64m", 64 << 20), ("5 kb", 5 << 10), ("12", 12), ("-1", -1)])
def test_sizes_as_spark_writes_them(text, size):
    assert common._bytes(text) == size


def test_a_task_gives_its_memory_back(monkeypatch):
    done = []
    monkeypatch.setattr(common, "trim", lambda: done.append("trimmed"))
    batch = pa.RecordBatch.from_pydict({"x": [1]})
    run = common.trimmed(lambda batches: (done.append("batch") or b for b in batches))
    assert list(run(iter([batch, batch]))) == [batch, batch]
    assert done == ["batch", "batch", "trimmed"]
