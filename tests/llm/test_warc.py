import base64
import hashlib

import pytest

from tabscope.llm import warc
from tabscope.llm.common import scratch_dir, scratch_table

#: Payloads that hold the magic, whole records, or the start of one.
TRAPS = [
    (1, "http://a/\r\nWARC-Type: x", "x" * 5000 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (2, None, None),
    (3, "u", ""),
    (4, "http://ü/ y", "WARC/1.0\r\nA: b\r\nContent-Length: 10\r\n\r\n" * 300),
    (5, "n", warc.record(9, 9, "z", b"inner payload", None).decode() * 30),
    (6, "n", "same text"),
    (7, "n", "same text"),
    (7, "n", "same text"),
    (None, "n", "same text"),
    (None, "n", "nobody's"),
    (None, "n", "nobody's"),
    (8, "n", "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n" + "y" * 70_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*t, "extra", 1) for t in TRAPS]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, file string, bytes long"
    ).repartition(3)


def plain(rows, least=0):
    """Expected rows; of equal ids any one may be the response."""
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    done = set()
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if len(data) < least or html not in done and (html or "") not in done:
            done.add(html or "")
            out.append((page_id, len(data), digest, "response", None))
        else:
            out.append((page_id, len(data), digest, "revisit", first.get(html or "")))
    return sorted(out, key=repr)


@pytest.mark.parametrize("step", [1 << 23, 1 << 16, 5000, 777])
def test_traps_at_every_range_size(spark, pages, rows, step):
    written = warc.write_archives(pages, scratch_dir(spark, "warc-test"))
    assert rows(warc.read_archives(written, step)) == plain(TRAPS)


def test_pages_of_the_test_tables(spark, rows):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    twice = table.unionAll(table.selectExpr("page_id + 100000", "url", "html"))
    want = plain([tuple(r) for r in twice.select("page_id", "url", "html").collect()])
    assert rows(warc.round_trip(twice)) == want


def test_many_archives_and_small_payloads(spark, pages, rows, monkeypatch):
    assert rows(warc.round_trip(pages, least_bytes=9)) == plain(TRAPS, 9)


def test_a_task_that_runs_twice_changes_nothing(spark, pages, rows, monkeypatch):
    def twice(frame, name):
        if name == "warc-archives":
            frame.write.format("noop").mode("overwrite").save()
        return scratch_table(frame, name)

    monkeypatch.setattr(warc, "scratch_table", twice)
    assert rows(warc.round_trip(pages)) == plain(TRAPS)


def test_empty_table(pages):
    assert warc.round_trip(pages.where("false")).count() == 0


def test_damage_is_an_error(spark, pages):
    folder = scratch_dir(spark, "warc-damage")
    written = warc.write_archives(pages, folder)
    fs, path = warc.files_at(written.first().file)
    with fs.open_input_stream(path) as stream:
        data = stream.read()
    with fs.open_output_stream(path) as stream:
        stream.write(data.replace(b"Content-Length: ", b"Content-Length: 1", 1))
    with pytest.raises(Exception, match="does not end at|no record at"):
        warc.read_archives(written).collect()


@pytest.mark.parametrize("step", [1 << 23, 1 << 16, 777])
def test_urls_of_any_length(spark, rows, step):
    magic = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    made = [
        (1, "http://a/", "before"),
        (2, "http://a/" + "漢" * 30_000, "a long one"),
        (3, "data:" + "x" * 65_536, magic * 3),
        (4, "http://a/?" + "WARC/1.1" * 50_000, magic),
        (5, "http://a/", "A: WARC/1.1\r\n" * 20_000),
        (6, "u", "WARC/1.1\r\nA: " + "y" * 300_000),
        (7, "u", "after"),
    ]
    pages = spark.createDataFrame(made, "page_id long, url string, html string").coalesce(1)
    written = warc.write_archives(pages, scratch_dir(spark, "warc-long"))
    assert rows(warc.read_archives(written, step)) == plain(made)
