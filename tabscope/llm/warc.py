"""WARC archives: written record by record, read back by verified record boundaries.

Writing: pages with equal payloads share one response record; the others become revisit
records that refer to it and carry the headers of the full payload. Tasks write archives
of bounded size next to each other.

Reading needs the places where records start, and the magic "WARC/1." may also stand in a
payload. Tasks therefore look at byte ranges of the archives and emit every candidate: a
place where the magic is followed by a well-formed header, with its successor, the place
where the next record must start. Inside a range a task follows successors to the first
one outside. Pointer jumping from the start of each file over these links, doubling the
jump each round, leaves the places where ranges are really entered; candidates that the
chain from the file's start never reaches are payload. The second pass parses each range
from its entry on.

Defined results: a null html is an empty payload; a null page_id comes after all others
and is written without an id; of equal pages with equal ids one is the response; null and
odd URLs are escaped, of any length; payloads below ``least_bytes`` are never revisits; an empty table
gives no archive. A chain that breaks (a damaged file) raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import (
    files_at,
    identified,
    map_batches,
    scratch_dir,
    scratch_table,
    small_side,
)

ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
#: The first step in which a record header is read; longer headers are read on.
HEADER_BYTES = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROW = "_tabscope_row"

_MAGIC = b"WARC/1."
_START = re.compile(rb"WARC/1\.[01]\r\n")
_LINES = re.compile(rb"(?:[!-9;-~]+:[^\r\n]*\r\n)*+")
_UNFINISHED = re.compile(rb"(?:[!-9;-~]+(?::[^\r\n]*\r?)?|\r)?\Z")
_LENGTH = re.compile(rb"^content-length:[ \t]*(\d{1,18})[ \t]*\r$", re.I | re.M)
_END = b"\r\n\r\n"
_BROKEN = -1


# Writing -------------------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    row: int, page_id: int | None, url: str | None, payload: bytes, revisits: tuple | None
) -> bytes:
    """A response record, or with ``revisits`` (row, page_id) of the response a revisit."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = http if revisits else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisits else "response"),
        ("WARC-Record-ID", f"<urn:page-row:{row & (1 << 64) - 1:016x}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisits:
        fields.append(("WARC-Profile", PROFILE))
        fields.append(("WARC-Refers-To", f"<urn:page-row:{revisits[0] & (1 << 64) - 1:016x}>"))
        if revisits[1] is not None:
            fields.append(("X-Refers-To-Page-ID", str(revisits[1])))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + _END


def first_of_equal(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(digest, bytes, first row, first id) of the payloads that several pages share.

    Equal means equal SHA-256 and length.
    """
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", ROW)
    return (
        pages.select("page_id", ROW, *_payload_key())
        .where(F.col("_bytes") >= least_bytes)
        .groupBy("_digest", "_bytes")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(
            "_digest",
            "_bytes",
            F.col(f"first.{ROW}").alias("first_row"),
            F.col("first.page_id").alias("first_id"),
        )
    )


def _payload_key():
    payload = F.coalesce("html", F.lit(""))
    return F.sha2(payload, 256).alias("_digest"), F.octet_length(payload).alias("_bytes")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``folder``; returns (file, bytes).

    The archives are what the rows name; a task that ran twice has left others.
    """
    rows = identified(pages, ROW).select("page_id", "url", "html", ROW)
    equal = scratch_table(first_of_equal(rows, least_bytes), "warc-equal")
    side = small_side(equal, equal.count(), 128)
    marked = rows.withColumns(dict(zip(("_digest", "_bytes"), _payload_key(), strict=True)))
    marked = marked.join(side, ["_digest", "_bytes"], "left").select(
        "page_id", "url", "html", ROW, "first_row", "first_id"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = files_at(folder)
        part = TaskContext.get().partitionId()
        name, out, size, made = "", None, 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "bytes": [size]})

        for batch in batches:
            for page_id, url, html, row, first, first_id in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if out is None:
                    # A name of its own: a task that runs twice writes over nothing.
                    name = f"pages-{part:06d}-{made:04d}-{uuid.uuid4().hex}.warc"
                    out, size = fs.open_output_stream(f"{path}/{name}"), 0
                revisits = (first, first_id) if first is not None and first != row else None
                size += out.write(record(row, page_id, url, (html or "").encode(), revisits))
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out, made = None, made + 1
        if out is not None:
            yield close()

    return scratch_table(map_batches(marked, write, "file string, bytes long"), "warc-archives")


# Reading -------------------------------------------------------------------------------


def header_lines(data: bytes, at: int, more: Callable[[int], bytes]) -> tuple[bytes, int]:
    """``data``, read on as far as needed, and the end of the header lines from ``at`` on.

    ``more(n)`` gives what follows the first ``n`` bytes: as many again, or none at the end.
    """
    while True:
        at = _LINES.match(data, at).end()
        further = more(len(data)) if _UNFINISHED.match(data, at) else b""
        if not further:
            return data, at
        data += further


def candidates(
    data: bytes, base: int, limit: int, more: Callable[[int], bytes] = lambda n: b""
) -> list[tuple[int, int]]:
    """(place, successor) of the candidates that start before ``limit``; places from ``base``.

    A candidate inside the header lines of another one ends where that one ends, so lines
    are looked at once.
    """
    found = []
    begin = end = 0
    lengths: list[tuple[int, int]] = []
    at = data.find(_MAGIC)
    while at >= 0 and base + at < limit:
        start = _START.match(data, at)
        if start:
            first = start.end()
            if not begin <= first < end:
                begin, (data, end) = first, header_lines(data, first, more)
                lengths = [(m.start(), int(m[1])) for m in _LENGTH.finditer(data, begin, end)]
            nth = bisect_left(lengths, (first,))
            if first < end and data[end : end + 2] == b"\r\n" and nth < len(lengths):
                found.append((base + at, base + end + 2 + lengths[nth][1] + len(_END)))
        at = data.find(_MAGIC, at + 1)
    return found


def _ranges(archives: DataFrame, step: int) -> DataFrame:
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(step).cast("long"))
    split = archives.where("bytes > 0").select("file", "bytes", F.explode(starts).alias("start"))
    return split.repartition("file", "start")


def _exits(step: int):
    """(file, bytes, place, exit) of candidates: the first successor outside their range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                limit = min(start + step, size)
                fs, path = files_at(file)
                with fs.open_input_file(path) as stream:
                    data = stream.read_at(min(limit + HEADER_BYTES, size) - start, start)
                    more = lambda n: stream.read_at(min(n, size - start - n), start + n)  # noqa: B023, E731
                    links = candidates(data, start, limit, more)
                leave: dict[int, int] = {}
                for place, successor in reversed(links):
                    leave[place] = successor if successor >= limit else leave.get(successor, _BROKEN)
                n = len(leave)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * n, pa.string()),
                        pa.array([size] * n, pa.int64()),
                        pa.array(list(leave), pa.int64()),
                        pa.array(list(leave.values()), pa.int64()),
                    ],
                    names=["file", "bytes", "place", "exit"],
                )

    return run


def entries(archives: DataFrame, step: int = RANGE_BYTES) -> DataFrame:
    """(file, place): where the chain from each file's start enters the ranges.

    Only candidates that some candidate exits to, or that start a file, can be entries;
    jumps double each round, so the rounds are the logarithm of the ranges of a file.
    """
    chain = scratch_table(
        map_batches(_ranges(archives, step), _exits(step), "file string, bytes long, place long, exit long"),
        "warc-candidates",
    )
    targets = chain.select("file", F.col("exit").alias("place")).distinct()
    first = archives.where("bytes > 0").select("file", F.lit(0).cast("long").alias("place"))
    jumps = chain.join(targets.unionAll(first).distinct(), ["file", "place"], "left_semi")
    jumps = jumps.select("file", "bytes", "place", F.col("exit").alias("to"))
    jumps = scratch_table(jumps, "warc-jumps")
    reached = first
    longest = archives.agg(F.max("bytes")).first()[0] or 0
    rounds = (longest // step + 1).bit_length()
    for n in range(rounds):
        ahead = reached.join(jumps, ["file", "place"]).select("file", "bytes", F.col("to").alias("place"))
        reached = scratch_table(
            reached.unionAll(ahead.where("place <> bytes and place >= 0").select("file", "place")).distinct(),
            "warc-reached",
        )
        if n + 1 < rounds:
            after = jumps.select("file", F.col("place").alias("to"), F.col("to").alias("then"))
            # A jump that has left the file stays where it is.
            jumps = scratch_table(
                jumps.join(after, ["file", "to"], "left").select(
                    "file", "bytes", "place", F.coalesce("then", "to").alias("to")
                ),
                "warc-jumps",
            )
    return reached


class _Reader:
    """Bytes of a file by place, a few megabytes at a time."""

    def __init__(self, file: str, size: int) -> None:
        fs, path = files_at(file)
        self.stream, self.size, self.file = fs.open_input_file(path), size, file
        self.data, self.base = b"", 0

    def upto(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at``, fewer at the end of the file."""
        if not (self.base <= at and at + n <= self.base + len(self.data)):
            self.data = self.stream.read_at(min(max(n, 1 << 22), self.size - at), at)
            self.base = at
        return self.data[at - self.base : at - self.base + n]


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(b":", 1) for line in head.split(b"\r\n") if line)
    return {k.decode().lower(): v.strip().decode() for k, v in pairs}


def records(reader: _Reader, at: int, limit: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of the records that start from ``at`` on and before ``limit``."""
    while at < limit:
        data, lines, end = reader.upto(at, HEADER_BYTES), b"", 0
        start = _START.match(data)
        if start:
            data, end = header_lines(data, start.end(), lambda n: reader.upto(at + n, n))  # noqa: B023
            lines = data[start.end() : end]
        length = _LENGTH.search(lines)
        if not length or data[end : end + 2] != b"\r\n":
            raise ValueError(f"{reader.file}: no record at {at}")
        begin, n = at + end + 2, int(length[1])
        body = reader.upto(begin, n + len(_END))
        if body[n:] != _END:
            raise ValueError(f"{reader.file}: the record at {at} does not end at {begin + n}")
        yield _fields(lines), body[:n]
        at = begin + n + len(_END)


def page_of(fields: dict[str, str], block: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record."""
    head, _, payload = block.partition(_END)
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    size = len(payload) if kind == "response" else int(_fields(head.split(b"\r\n", 1)[1])["content-length"])
    number = lambda name: int(fields[name]) if name in fields else None
    return number("x-page-id"), size, digest, kind, number("x-refers-to-page-id")


def read_archives(archives: DataFrame, step: int = RANGE_BYTES) -> DataFrame:
    """One row per page record of ``archives(file, bytes)``."""
    enter = entries(archives, step).join(archives, ["file"]).withColumn(
        "start", F.col("place") - F.col("place") % step
    )
    enter = enter.groupBy("file", "bytes", "start").agg(F.min("place").alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, start, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                limit = min(start + step, size)
                rows = [page_of(*r) for r in records(_Reader(file, size), place, limit)]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=_READ)

    spread = enter.select("file", "bytes", "start", "place").repartition("file", "start")
    return map_batches(
        spread,
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


_READ = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def round_trip(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives and return what the archives hold of each page."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, least_bytes))
