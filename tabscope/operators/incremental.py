"""Profiles kept up to date by reading new files only.

Every file of a table gives a partial result of its own: a histogram, or distinct-count
sketches. Partials are appended to the store; a ledger lists the files whose partials
count. Bringing a table up to date lists its files, works out partials of those the
ledger does not hold in this very form (path, size, time of change), appends them, and
publishes the new ledger: a file that is gone or replaced is left out with it. What is
merged on reading are the partials of the ledger's files, so a refresh that fails changes
nothing and costs only space until :func:`compact`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.ranking import global_row_number
from tabscope.operators.shapes import bounded_broadcast
from tabscope.operators.sketches import sketch_rows, union_sketches
from tabscope.operators.value_dist import bucket_rows
from tabscope.plans.spec import ProfileInput, TableSpec, name_columns, number_columns
from tabscope.sources.lake_files import LakeTable
from tabscope.sources.store import VALUE_SCOPE, ResultStore

#: A file's identity in partials and ledger: the refresh that read it, and its number there.
FILE = ("load_id", "file_id")

#: Files are named to the reader one by one up to this many; beyond, the whole table is
#: opened and the files that are not new are skipped by their path.
NAMED_FILES = 10_000


@dataclass(frozen=True)
class Kind:
    """A partial result: its tables in the store, how it is made and merged."""

    files: str
    parts: str
    #: Rows of a file's partial from the opened new files, grouped by ``path`` and column.
    partial: Callable[..., DataFrame]
    #: Partials of many files as the result, a column key kept.
    merged: Callable[[DataFrame], DataFrame]


def _path(frame: DataFrame) -> DataFrame:
    return frame.select("*", F.col("_metadata.file_path").alias("_path"))


def _histogram(source: ProfileInput, **options) -> DataFrame:
    """(path, column key, ``col_val``, ``col_val_cnt``); combines on the map side."""
    groups = number_columns([(source, source.value_columns())])
    rows = bucket_rows(groups, with_columns=("_path",), **options)
    counted = rows.groupBy("_path", "ref", "col_val").agg(F.count(F.lit(1)).alias("col_val_cnt"))
    return name_columns(counted, groups)


def _merged_histogram(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*VALUE_SCOPE, "col_nm", "col_val").agg(
        F.sum("col_val_cnt").alias("col_val_cnt")
    )


def _sketches(source: ProfileInput, **options) -> DataFrame:
    groups = number_columns([(source, source.stat_columns())])
    return name_columns(sketch_rows(groups, with_columns=("_path",), **options), groups)


HISTOGRAM = Kind("histogram_files", "histogram_parts", _histogram, _merged_histogram)
SKETCH = Kind(
    "sketch_files",
    "sketch_parts",
    _sketches,
    lambda parts: union_sketches(parts, (*VALUE_SCOPE, "col_nm")),
)


def _scope(spec: TableSpec) -> dict[str, str]:
    return {c: getattr(spec, c) for c in VALUE_SCOPE}


def refresh(store: ResultStore, kind: Kind, spec: TableSpec, table: LakeTable, **options) -> int:
    """Bring the partials of one table up to date; the number of files that were read.

    The options belong to the partial (bucket options, sketch size): keep them the same
    over the refreshes of a table.
    """
    scope = _scope(spec)
    ledger = store.view(kind.files)
    key = ["path", "bytes", "changed"]
    known = store.read(kind.files, scope, ledger).select(*key, *FILE)
    there = table.files().checkpoint()
    new = there.join(known, key, "left_anti").checkpoint()
    count = new.count()
    kept = known.join(there, key, "left_semi")
    if not count and kept.count() == known.count():
        return 0
    # Files are numbered within a refresh: partials of one that failed never count.
    load = F.lit(uuid.uuid4().hex).alias("load_id")
    numbered = global_row_number(new, [F.col(c) for c in key], "file_id").select(
        *key, load, "file_id"
    ).checkpoint()
    if count:
        if count <= NAMED_FILES:
            frame = _path(table.frame([r.path for r in new.select("path").collect()]))
        else:
            wanted = numbered.select(F.col("path").alias("_path"))
            frame = _path(table.frame()).join(bounded_broadcast(wanted, count, 1024), "_path", "left_semi")
        partial = kind.partial(ProfileInput(spec, frame), **options)
        ids = numbered.select(F.col("path").alias("_path"), *FILE)
        rows = partial.join(bounded_broadcast(ids, count, 1024), "_path").drop("_path")
        store.append(kind.parts, rows)
    store.replace_scope(kind.files, kept.unionByName(numbered), scope, ledger)
    return count


def live_parts(store: ResultStore, kind: Kind, spec: TableSpec) -> DataFrame:
    """The partials that count, a row per file, column and value."""
    scope = _scope(spec)
    files = store.read(kind.files, scope).select(*FILE)
    return store.read(kind.parts, scope).join(files, list(FILE), "left_semi")


def current(store: ResultStore, kind: Kind, spec: TableSpec) -> DataFrame:
    """The result over all files of the table as of its last refresh."""
    return kind.merged(live_parts(store, kind, spec))


def compact(store: ResultStore, kind: Kind, spec: TableSpec) -> None:
    """Rewrite a table's partials without those of files that are gone."""
    view = store.view(kind.parts)
    scope = _scope(spec)
    files = store.read(kind.files, scope).select(*FILE)
    rows = store.read(kind.parts, scope, view).join(files, list(FILE), "left_semi")
    store.replace_scope(kind.parts, rows, scope, view)
