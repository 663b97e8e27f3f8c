"""Tables that are folders of files: what files they hold, and reading some of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LakeTable:
    """A file or folder of one format. Folders are searched to any depth."""

    spark: SparkSession
    root: str
    schema: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def files(self) -> DataFrame:
        """(path, bytes, changed) of every data file; no file is opened."""
        listed = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(self.root)
        )
        meta = "_metadata"
        name = F.col(f"{meta}.file_name")
        return listed.where(~name.startswith("_") & ~name.startswith(".")).select(
            F.col(f"{meta}.file_path").alias("path"),
            F.col(f"{meta}.file_size").alias("bytes"),
            F.col(f"{meta}.file_modification_time").cast("timestamp_ntz").alias("changed"),
        )

    def frame(self, paths: Sequence[str] | None = None) -> DataFrame:
        """The table, or some of its files as :meth:`files` names them."""
        reader = self.spark.read.schema(self.schema).format(self.fmt).options(**self.options)
        if paths is None:
            return reader.option("recursiveFileLookup", "true").load(self.root)
        return reader.load([unquote(p) for p in paths])
