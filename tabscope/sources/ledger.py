"""What a long level has finished, kept until its results are merged.

A level runs job by job. Each job's rows go to a part of their own, and when the part is
complete an entry notes which tables it holds and how they were to be profiled. A level
that fails leaves its ledger; run again, it passes over tables that are noted with the
same plan and works on the rest. A table whose plan has changed is done anew, and its
older rows are left out.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import threading
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.plans.spec import TableSpec
from tabscope.sources.files import SmallFiles


def table_id(spec: TableSpec) -> str:
    return json.dumps([spec.owner_nm, spec.tab_nm], ensure_ascii=False)


def plan_id(spec: TableSpec, *options: object) -> str:
    """Equal for two runs that would profile the table the same way."""
    return hashlib.sha256(repr((spec, options)).encode()).hexdigest()


class Ledger:
    """Finished jobs of one level, below ``folder``."""

    def __init__(
        self,
        spark: SparkSession,
        files: SmallFiles,
        folder: str,
        now: dt.datetime,
        max_age: dt.timedelta | None,
    ):
        self.spark, self._files, self.folder, self._now = spark, files, folder, now
        self._lock = threading.Lock()
        self._entries = sorted(
            (
                json.loads(files.read(f"{folder}/{name}"))
                for name, _, _ in files.listed(folder)
                if name.startswith("done-") and name.endswith(".json")
            ),
            key=lambda entry: entry["nr"],
        )
        old = None if max_age is None else now - max_age
        if old and any(dt.datetime.fromisoformat(e["at"]) < old for e in self._entries):
            self.discard()

    def __bool__(self) -> bool:
        return bool(self._entries)

    def finished(self, table: str, plan: str) -> bool:
        """Whether the table's latest rows come from the same plan."""
        return self._latest().get(table, (None, None))[1] == plan

    def _latest(self) -> dict[str, tuple[int, str]]:
        return {t: (e["nr"], plan) for e in self._entries for t, plan in e["tables"].items()}

    def add(self, rows: DataFrame | None, tables: Mapping[str, str]) -> None:
        """Note a finished job; ``rows`` are written first, None where they are published."""
        part = schema = None
        if rows is not None:
            part, schema = f"part-{uuid.uuid4().hex}", rows.schema.json()
            rows.write.parquet(f"{self.folder}/{part}")
        with self._lock:
            self._note(part, schema, tables)

    def _note(self, part: str | None, schema: str | None, tables: Mapping[str, str]) -> None:
        entry = {
            "nr": max((e["nr"] for e in self._entries), default=0) + 1,
            "at": self._now.isoformat(),
            "part": part,
            "schema": schema,
            "tables": dict(tables),
        }
        data = json.dumps(entry, ensure_ascii=False).encode()
        self._files.put_if_absent(f"{self.folder}/done-{uuid.uuid4().hex}.json", data)
        self._entries.append(entry)

    def rows(self) -> DataFrame:
        """The rows of all parts, each table's from the job that did it last."""
        latest = self._latest()
        whole: dict[str, list[str]] = {}
        out: list[DataFrame] = []
        for entry in self._entries:
            path = f"{self.folder}/{entry['part']}"
            stale = [t for t in entry["tables"] if latest[t][0] != entry["nr"]]
            if not stale:
                whole.setdefault(entry["schema"], []).append(path)
                continue
            key = F.to_json(F.array("owner_nm", "tab_nm"))
            plain = [json.dumps(json.loads(t), ensure_ascii=False, separators=(",", ":")) for t in stale]
            out.append(self._read(entry["schema"], path).where(~key.isin(plain)))
        out += [self._read(schema, *paths) for schema, paths in whole.items()]
        first, *rest = out
        for frame in rest:
            first = first.unionByName(frame)
        return first

    def _read(self, schema: str, *paths: str) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(*paths)

    def discard(self) -> None:
        self._files.delete(self.folder)
        self._entries = []
