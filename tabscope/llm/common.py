"""Helpers the operators share: row batches, scratch tables, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import re
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

import tabscope
from tabscope.session import ensure_checkpoint_dir, shared_dir

#: Words as the contracts cut them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of an Arrow batch: they bound a worker's memory where texts are long. A
#: batch ends with the row that passes the bytes.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20

#: A frame is broadcast only below this many bytes, counted before the join.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Cap the rows and bytes Spark hands a Python worker at once, for the session.

    Lower values of the user's stay. The plan of a frame that is made now may run later, so
    the settings can not be taken back.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _bytes(spark.conf.get(key)) <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def _bytes(setting: str) -> int:
    """A size as Spark writes it: digits and a unit."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", setting.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index((unit or "b")[0])


_BLOCK_BITS = 15
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once a session, as ``addPyFile`` does."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(tabscope.__file__).parent
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"tabscope/{file.relative_to(root)}")
    uri = f"{scratch_dir(spark, 'package')}/tabscope.zip"
    fs, path = files_at(uri)
    with fs.open_output_stream(path) as stream:
        stream.write(made.getvalue())
    context.addPyFile(uri)
    _SHIPPED.add(context.applicationId)


def map_batches(
    df: DataFrame,
    func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """``mapInArrow`` over batches of a bounded number of rows; tasks give memory back."""
    small_batches(df.sparkSession)
    ship_package(df.sparkSession)
    return df.mapInArrow(trimmed(func), schema)


def trimmed(
    func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``func``, and when its task ends what the allocators hold is given back.

    A worker outlives its task, and waits beside stages that need the memory themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from func(batches)
        trim()

    return run


def appended(
    df: DataFrame, inputs: list[str], func: Callable[..., list], fields: list[T.StructField]
) -> DataFrame:
    """``df`` with the columns ``func`` computes from the Arrow columns ``inputs``.

    ``func`` gets one Arrow array per input and returns one value sequence per field.
    Every other column passes through, so that a decision needs no join back to its row.
    """
    schema = T.StructType([*df.schema.fields, *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]
    places = [df.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = func(*(batch.column(i) for i in places))
            new = [pa.array(v, type=k) for v, k in zip(made, kinds, strict=True)]
            columns = [*batch.columns, *new]
            names = [*batch.schema.names, *(f.name for f in fields)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(df, run, schema)


def runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches put together until they hold ``size`` bytes: what repeats is worked on once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


_claimed: list = []
_LIBC = ctypes.CDLL(None) if os.name == "posix" else None


def claim(owner: object, forget: Callable[[], None]) -> None:
    """Let only one operator keep a cache in this worker: another one's is emptied.

    Workers outlive a stage, and the caches of several stages would add up, with whatever
    the allocators keep for themselves.
    """
    if _claimed and _claimed[0] is owner:
        return
    if _claimed:
        _claimed[1]()
        gc.collect()
        trim()
    _claimed[:] = [owner, forget]


def trim() -> None:
    """Give back what the allocators keep of freed memory."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, deleted when the session ends."""
    ensure_checkpoint_dir(spark)
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return str(fs.makeQualified(target).toString())


def scratch_path(df: DataFrame, name: str) -> str:
    """``df`` written to the shared folder; the URI of the table."""
    path = f"{scratch_dir(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return path


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later reads need no lineage."""
    path = scratch_path(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` hinted for broadcast if its counted rows stay under the bound, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


#: Bits of a row's number inside its file; the others name the file.
ROW_BITS = 26


def identified(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number per row that stays the same in every plan over its files.

    It is exact: the row's place in its file below a hash of the file's path, and a seed of
    the hash is taken under which no two of the files meet. A frame that is not a plain
    read of files is written to the shared folder first.
    """
    try:
        place = df.metadataColumn("_metadata")
    except AnalysisException:
        return identified(scratch_table(df, "rows"), name)
    seed = _apart(df.inputFiles())
    # Spark's xxhash64 goes on from the hash of the columns before.
    file = F.xxhash64(F.lit(seed), place["file_path"])
    row = place["row_index"]
    fits = F.when(row < (1 << ROW_BITS), row).otherwise(
        F.raise_error(F.lit(f"a file holds more than 2^{ROW_BITS} rows")).cast("long")
    )
    return df.withColumn(name, F.shiftleft(file, ROW_BITS).bitwiseOR(fits))


def _apart(paths: list[str]) -> int:
    """A seed whose file numbers differ for all paths."""
    kept = (1 << (64 - ROW_BITS)) - 1
    # A row's metadata name local files with one slash.
    named = {re.sub("^file:///", "file:/", p) for p in paths}
    for seed in range(1000):
        base = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
        numbers = {xxhash.xxh64_intdigest(p.encode(), base) & kept for p in named}
        if len(numbers) == len(named):
            return seed
    raise RuntimeError(f"no seed keeps {len(paths)} files apart")


def content_order(df: DataFrame, seed: int, *columns: str) -> list[Column]:
    """Two 64-bit hashes of a row's values: the same order wherever the rows are stored.

    Rows that agree in both hold the same values in ``columns``, by default in every column
    of an atomic type.
    """
    plain = columns or [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.AtomicType) and not f.name.lower().startswith("_tabscope")
    ]
    cells = [F.col("`" + c.replace("`", "``") + "`") for c in plain]
    nulls = F.concat(F.lit("n"), *[F.when(c.isNull(), "1").otherwise("0") for c in cells])
    return [F.xxhash64(F.lit(seed), nulls, *cells), F.xxhash64(*reversed(cells), nulls, F.lit(~seed))]


def keeping_names(func: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For a stage that returns its documents' columns: those that are named like its own
    (``_tabscope...``) are renamed while it works."""

    @wraps(func)
    def stage(documents: DataFrame, *args, **options) -> DataFrame:
        names = documents.columns
        own = [c for c in names if c.lower().startswith("_tabscope")]
        if not own:
            return func(documents, *args, **options)
        # Names of the user's that no operator uses, nor any other column.
        kept = {c: f"kept_{i}_{uuid.uuid4().hex}" for i, c in enumerate(own)}
        made = func(documents.withColumnsRenamed(kept), *args, **options)
        return made.withColumnsRenamed({new: old for old, new in kept.items()}).select(
            *["`" + c.replace("`", "``") + "`" for c in names]
        )

    return stage


def dense_blocks(
    table: DataFrame, bits: int, columns: list[str], kind: type = np.int64
) -> DataFrame:
    """Columns of ``table(at, ...)`` as arrays of 2**bits entries, 0 where ``at`` is absent.

    Their size is fixed by ``bits``; they are packed on the executors, 32k entries a row.
    """
    block = min(bits, _BLOCK_BITS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            for b in np.unique(at >> block):
                mine = at >> block == b
                full = blocks.setdefault(int(b), np.zeros((len(columns), 1 << block), kind))
                for i in range(len(columns)):
                    values = batch.column(i + 1).to_numpy(zero_copy_only=False)
                    full[i][at[mine] & ((1 << block) - 1)] = values[mine]
        for b, full in blocks.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int64()), pa.array([full.tobytes()], pa.binary())],
                names=["block", "counts"],
            )

    spread = table.select("at", *columns).repartition(F.shiftright("at", block))
    return spread.mapInArrow(pack, "block long, counts binary")


def joined_blocks(
    rows: Iterable[tuple[int, bytes]], bits: int, columns: int, kind: type = np.int64
) -> list[np.ndarray]:
    """The arrays whose blocks are ``rows``."""
    block = min(bits, _BLOCK_BITS)
    out = np.zeros((columns, 1 << bits), kind)
    for number, counts in rows:
        part = np.frombuffer(counts, kind).reshape(columns, -1)
        out[:, number << block : (number + 1) << block] = part
    return list(out)


def parquet_rows(uri: str) -> Iterator[tuple]:
    """Rows of a small Parquet table on shared storage, read inside a task."""
    fs, path = files_at(uri)
    for info in fs.get_file_info(pafs.FileSelector(path)):
        if info.base_name.endswith(".parquet"):
            table = pq.read_table(info.path, filesystem=fs)
            yield from zip(*(c.to_pylist() for c in table.columns), strict=True)


def parquet_columns(uri: str) -> list[np.ndarray]:
    """Columns of a Parquet table of numbers on shared storage, read inside a task."""
    fs, path = files_at(uri)
    files = [i.path for i in fs.get_file_info(pafs.FileSelector(path)) if i.base_name.endswith(".parquet")]
    tables = [pq.read_table(f, filesystem=fs) for f in sorted(files)]
    return [c.to_numpy() for c in pa.concat_tables(tables).columns]


def files_at(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI on any store pyarrow reaches (file, hdfs, s3, gs)."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:/") :].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def measured_bytes(df: DataFrame, *texts: str) -> int:
    """Bytes of a frame of numbers and the named texts, counted: 128 a row and the texts."""
    sizes = [F.coalesce(F.octet_length(t), F.lit(0)) for t in texts]
    total = F.sum(sum(sizes, F.lit(128)).cast("long"))
    return df.agg(total).first()[0] or 0


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8; bytes.split() cuts at exactly the six characters of WORD."""
    return text.encode().split() if text else []


WORD_PATTERN = re.compile(WORD)
