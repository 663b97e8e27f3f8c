"""Saving the older schema / table / column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.operators.dictionary.legacy import DB_NO, LEGACY_TABLES, repository_columns, rows_exist


class LegacyRepository:
    """The three lists as parquet tables, one partition per database number."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root.rstrip("/")

    def _existing(self, name: str, like: DataFrame) -> DataFrame:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}")
        fs = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return like.limit(0)
        return self._spark.read.schema(like.schema).parquet(f"{self._root}/{name}")

    def has_rows(self, lists: tuple[DataFrame, DataFrame, DataFrame], db_no: int) -> bool:
        stored = [self._existing(name, df) for name, df in zip(LEGACY_TABLES, lists)]
        return rows_exist(*stored, db_no).first()["cnt"] > 0

    def save(
        self,
        schemas: DataFrame,
        tables: DataFrame,
        columns: DataFrame,
        db_no: int,
        ignore: bool = False,
    ) -> None:
        """Save the lists of one database; rows already there are an error unless ignored.

        With ``ignore`` they are replaced.
        """
        lists = (schemas, tables, repository_columns(columns))
        if self.has_rows(lists, db_no) and not ignore:
            raise ValueError(f"database {db_no} is already stored; pass ignore=True to replace it")
        for name, df in zip(LEGACY_TABLES, lists):
            df.filter(F.col(DB_NO) == db_no).drop(DB_NO).write.mode("overwrite").parquet(
                f"{self._root}/{name}/{DB_NO}={db_no}"
            )
