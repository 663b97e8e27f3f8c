"""Result store: parquet tables below one root.

Every load writes a directory of its own, and only when all of it is there an entry in the
table's log makes it part of the table: which scopes (values of the partition columns) it
replaces, and the directories that hold them now. Readers follow the log. A load that
fails, or runs beside a reader, changes nothing and leaves nothing; a load without rows
publishes an empty scope. Loads of different scopes may run at once; of two that change
the same scope the later one fails. Directories no longer named are removed one load
later, so that readers who have opened the table before keep their rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.operators.dictionary.common import DICTIONARY_TYPES
from tabscope.operators.registration import COLUMN_MASTER, TABLE_MASTER
from tabscope.sources.files import SmallFiles
from tabscope.sources.ledger import Ledger
from tabscope.sources.scopelog import Changed, ScopeLog, View

SNAPSHOT_SCOPE = ("db_nm", "chasu")
VALUE_SCOPE = ("db_nm", "prfl_id", "owner_nm", "tab_nm")
PATTERN_SCOPE = ("db_nm", "prfl_id", "owner_nm", "tab_nm")

#: Columns and layout of every table: name -> (column types, partition columns).
_DICTIONARY = {
    f"dic_{kind}": ({**types, "cr_dt": "date"}, SNAPSHOT_SCOPE)
    for kind, types in DICTIONARY_TYPES.items()
}
TABLES: dict[str, tuple[dict[str, str], tuple[str, ...]]] = {
    "dic_snapshots": ({"cr_dt": "timestamp_ntz"}, SNAPSHOT_SCOPE),
    **_DICTIONARY,
    "column_values": (
        {
            "col_nm": "string", "col_val": "string", "col_val_cnt": "bigint",
            "min_reg_dt": "timestamp_ntz", "max_reg_dt": "timestamp_ntz",
        },
        VALUE_SCOPE,
    ),
    # Partial results per file of a lake table, and the files whose partials count.
    **{
        f"{kind}_files": (
            {
                "path": "string", "bytes": "bigint", "changed": "timestamp_ntz",
                "load_id": "string", "file_id": "bigint",
            },
            VALUE_SCOPE,
        )
        for kind in ("histogram", "sketch")
    },
    "histogram_parts": (
        {
            "load_id": "string", "file_id": "bigint", "col_nm": "string", "col_val": "string",
            "col_val_cnt": "bigint",
        },
        VALUE_SCOPE,
    ),
    "sketch_parts": (
        {"load_id": "string", "file_id": "bigint", "col_nm": "string", "sketch": "binary"},
        VALUE_SCOPE,
    ),
    "column_patterns": (
        {
            "col_nm": "string", "col_pat": "string", "col_pat_cnt": "bigint",
            "col_pat_rt": "string",
        },
        PATTERN_SCOPE,
    ),
    "table_master": (TABLE_MASTER, ()),
    "column_master": (COLUMN_MASTER, ()),
}
_SCOPE_TYPES = {"chasu": "int"}

#: Times an update of a master is made anew because another load came first.
UPDATE_ATTEMPTS = 10

# Characters Spark escapes in a partition directory name.
_ESCAPED = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


def _directory(column: str, value: object) -> str:
    text = str(value)
    if value is None or text == "":
        raise ValueError(f"scope column {column} needs a value")
    return f"{column}=" + _ESCAPED.sub(lambda m: f"%{ord(m.group()):02X}", text)


class ResultStore:
    """The profile tables of a project."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._root = root.rstrip("/")
        self._files = SmallFiles(spark)
        self._logs: dict[str, ScopeLog] = {}
        self._opened = threading.local()

    def path(self, table: str) -> str:
        return f"{self._root}/{table}"

    def schema(self, table: str) -> T.StructType:
        columns, scope = TABLES[table]
        fields = {c: columns.get(c, _SCOPE_TYPES.get(c, "string")) for c in (*columns, *scope)}
        return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields.items()))

    def _log(self, table: str) -> ScopeLog:
        return self._logs.setdefault(table, ScopeLog(self._files, self.path(table)))

    @contextmanager
    def resumable(
        self, level: str, now: dt.datetime, max_age: dt.timedelta | None = None
    ) -> Iterator[Ledger]:
        """The ledger of a level: removed when the level ends well, kept when it fails.

        One that a failed run has left is taken up again unless it is older than
        ``max_age``.
        """
        name = hashlib.sha256(level.encode()).hexdigest()[:24]
        folder = f"{self._root}/_staging/{name}"
        ledger = Ledger(self.spark, self._files, folder, now, max_age)
        yield ledger
        ledger.discard()

    # Reading and writing ---------------------------------------------------------------

    def view(self, table: str) -> View:
        """The table as it is now; what a later load is compared with."""
        return self._log(table).view()

    def read(
        self,
        table: str,
        scope: Mapping[str, object] | None = None,
        view: View | None = None,
    ) -> DataFrame:
        """The table, empty if nothing has been published.

        ``scope`` gives values for a leading part of the partition columns: only
        directories inside it are opened, and only its rows are returned.
        """
        view = view or self.view(table)
        scope = self._leading(table, scope or {})
        inside = view.within(["/".join(_directory(c, v) for c, v in scope.items())])
        directories = sorted({d for ds in inside.values() for d in ds})
        if not directories:
            # Seen to be empty when a query is planned, so that nothing moves to meet it.
            return self.spark.createDataFrame([], self.schema(table)).where(F.lit(False))
        schema = T.StructType([*self.schema(table).fields, T.StructField("load", T.StringType())])
        paths = [f"{self.path(table)}/{d}" for d in directories]
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        return reader.parquet(*paths).drop("load")

    @staticmethod
    def _leading(table: str, scope: Mapping[str, object]) -> Mapping[str, object]:
        _, layout = TABLES[table]
        if list(scope) != list(layout[: len(scope)]):
            raise ValueError(f"{table} is laid out by {layout}; got the scope {list(scope)}")
        return scope

    def replace_scope(
        self,
        table: str,
        df: DataFrame,
        scope: Mapping[str, object],
        since: View | None = None,
    ) -> None:
        """Replace all rows of one scope by ``df``.

        ``since`` is the table as ``df`` was made from it; by default as it is now.

        ``scope`` gives values for a leading part of the table's partition columns; the
        rest are written as partitions below it. No rows means an empty scope.
        """
        self._load(table, df, [self._leading(table, scope)], since=since)

    def replace_scopes(
        self, table: str, df: DataFrame, scopes: Iterable[Mapping[str, object]]
    ) -> None:
        """Replace several full scopes by one load."""
        _, layout = TABLES[table]
        scopes = list(scopes)
        for scope in scopes:
            if list(scope) != list(layout):
                raise ValueError(f"{table} is laid out by {layout}; got the scope {list(scope)}")
        self._load(table, df, scopes, fixed={})

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows without replacing any."""
        self._load(table, df, [], fixed={})

    def _load(
        self,
        table: str,
        df: DataFrame,
        scopes: Sequence[Mapping[str, object]],
        fixed: Mapping[str, object] | None = None,
        since: View | None = None,
    ) -> None:
        """Write ``df``, then publish it in place of ``scopes``.

        ``fixed`` gives partition values that ``df`` need not hold; by default those of
        the only scope.
        """
        columns, layout = TABLES[table]
        fixed = scopes[0] if fixed is None else fixed
        replaced = ["/".join(_directory(c, v) for c, v in scope.items()) for scope in scopes]
        below = [c for c in layout if c not in fixed]
        body = [
            (F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n)
            for n, t in columns.items()
            if n not in fixed
        ]
        since = since or self.view(table)
        load = f"load={uuid.uuid4().hex}"
        steps = [load, *[_directory(c, v) for c, v in fixed.items()]]
        target = "/".join([self.path(table), *steps])
        try:
            rows = df.select(*body, *[c for c in below if c not in columns])
            self._write(rows, below, target)
            added = {
                "/".join([*steps[1:], *tail]): ["/".join([*steps, *tail])]
                for tail in self._partitions(target, len(below))
            }
            self._log(table).commit(replaced, added, since)
        except BaseException:
            self._files.delete(f"{self.path(table)}/{load}")
            raise

    def _partitions(self, target: str, depth: int) -> list[list[str]]:
        """Directory names of the partitions below a finished load that hold files."""
        fs, path = self._files.at(target)
        if not fs.exists(path):
            return []
        if not depth:
            return [[]]
        _, pattern = self._files.at("/".join([target, *["*=*"] * depth]))
        return [
            str(status.getPath().toString()).split("/")[-depth:]
            for status in fs.globStatus(pattern)
        ]

    @staticmethod
    def _write(rows: DataFrame, partitions: Sequence[str], target: str) -> None:
        """Write, with rows of one partition brought together and large ones split.

        Without the rebalance every task would leave a file in every partition.
        """
        if partitions:
            rows = rows.hint("rebalance", *partitions)
            rows.write.partitionBy(*partitions).parquet(target)
        else:
            rows.write.parquet(target)

    def latest_revision(self, table: str) -> int:
        """The number of the newest published load, 0 if there is none."""
        return self.view(table).number

    def vacuum(self, table: str, hours: float = 24.0) -> list[str]:
        """Remove what loads that were killed have left, if last changed before ``hours``."""
        found = self._log(table).unknown(int((time.time() - 3600 * hours) * 1000))
        for name in found:
            self._files.delete(f"{self.path(table)}/{name}")
        return found

    def master(self, table: str) -> DataFrame:
        """A master table as last published."""
        view = self.view(table)
        self._opened.__dict__[table] = view
        return self.read(table, view=view)

    def write_master(self, table: str, df: DataFrame) -> None:
        """Publish a new master; ``df`` may read the present one.

        If this thread opened the master by :meth:`master` before, and it has been changed
        since, it is not overwritten.
        """
        self.replace_scope(table, df, {}, self._opened.__dict__.pop(table, None))

    def update_master(self, table: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """Publish ``change(master)``; made anew if another load comes first."""
        for attempt in range(UPDATE_ATTEMPTS):
            try:
                self.write_master(table, change(self.master(table)))
                return
            except Changed:
                if attempt == UPDATE_ATTEMPTS - 1:
                    raise
