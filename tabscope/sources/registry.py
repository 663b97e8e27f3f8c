"""Named sources: an id stands for a way to get DataFrames."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabscope.operators.remote import RemoteTable
from tabscope.sources import jdbc

logger = logging.getLogger(__name__)

#: A table by its name, and by its owner where the source has owners.
Reader = Callable[..., DataFrame]
Remote = Callable[[str, str], RemoteTable]


class SourceRegistry:
    """Sources by id. Each resolves a table name to a DataFrame, lazily."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._readers: dict[str, Reader] = {}
        self._remotes: dict[str, Remote] = {}

    def register(self, source_id: str, reader: Reader) -> Reader:
        """Register a reader; an id that is taken keeps its first reader."""
        if source_id in self._readers:
            logger.warning("source %r is already registered; keeping the first one", source_id)
            return self._readers[source_id]
        self._readers[source_id] = reader
        return reader

    def register_files(
        self,
        source_id: str,
        root: str,
        fmt: str = "parquet",
        schemas: Mapping[str, StructType | str] | None = None,
        **options: str,
    ) -> Reader:
        """Tables are files or directories ``root/<table>.<fmt>``, of any format Spark reads.

        ``schemas`` gives the columns of tables whose format holds none (csv), or spares a
        pass that infers them (json).
        """
        schemas = schemas or {}

        def read(table: str) -> DataFrame:
            reader = self._spark.read.format(fmt).options(**options)
            if table in schemas:
                reader = reader.schema(schemas[table])
            return reader.load(f"{root}/{table}.{fmt}")

        return self.register(source_id, read)

    def register_catalog(self, source_id: str, database: str) -> Reader:
        """Tables of a database in Spark's own catalog; Spark can also group them by SQL."""

        def read(table: str) -> DataFrame:
            return self._spark.table(f"{database}.{table}")

        def remote(owner: str, table: str) -> RemoteTable:
            return RemoteTable("spark", (database, table), self._spark.sql, lambda: read(table))

        self._remotes.setdefault(source_id, remote)
        return self.register(source_id, read)

    def register_jdbc(
        self,
        source_id: str,
        options: Mapping[str, str],
        vendor: str,
        splits: Mapping[str, Mapping[str, str]] | None = None,
    ) -> Reader:
        """Tables of a relational source, quoted as the vendor does.

        A table is given by name and owner, or as ``owner.table`` where the owner holds no
        dot. ``splits`` gives parallel reads per table, under ``owner.table``.
        """
        splits = splits or {}

        def read(table: str, owner: str | None = None) -> DataFrame:
            parts = table.split(".", 1) if owner is None else (owner, table)
            return jdbc.read_table(
                self._spark, options, jdbc.quoted(vendor, *parts), splits.get(".".join(parts))
            )

        def remote(owner: str, table: str) -> RemoteTable:
            return RemoteTable(
                vendor,
                (owner, table),
                lambda select: jdbc.read_query(self._spark, options, select),
                lambda: read(table, owner),
            )

        self._remotes.setdefault(source_id, remote)
        return self.register(source_id, read)

    def get(self, source_id: str) -> Reader:
        if source_id not in self._readers:
            raise KeyError(f"unknown source {source_id!r}; registered: {self.list()}")
        return self._readers[source_id]

    def table(self, source_id: str, table: str, owner: str | None = None) -> DataFrame:
        read = self.get(source_id)
        return read(table) if owner is None else read(table, owner)

    def remote(self, source_id: str, owner: str, table: str) -> RemoteTable:
        """The table for a profiler whose grouping the source is to do."""
        self.get(source_id)
        if source_id not in self._remotes:
            raise ValueError(f"source {source_id!r} runs no SELECTs")
        return self._remotes[source_id](owner, table)

    def list(self) -> list[str]:
        return [*self._readers]

    def close(self, source_id: str) -> None:
        self._readers.pop(source_id, None)
        self._remotes.pop(source_id, None)

    def close_all(self) -> None:
        self._readers.clear()
        self._remotes.clear()


def adhoc_query(
    spark: SparkSession,
    query: str,
    frames: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run a SELECT over named frames (``{name}``) with bound parameters (``:name``)."""
    return spark.sql(query, args=dict(args) if args else None, **(frames or {}))
