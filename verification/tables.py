"""The given tables: loading them, and their columns as the SQL side sees them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tabscope.sources.files import SmallFiles

# Columns and types of the given tables.
SCHEMAS: dict[str, dict[str, str]] = {
    "region": {"r_regionkey": "INTEGER", "r_name": "VARCHAR"},
    "nation": {"n_nationkey": "INTEGER", "n_name": "VARCHAR", "n_regionkey": "INTEGER"},
    "customer": {
        "c_custkey": "BIGINT", "c_name": "VARCHAR", "c_nationkey": "INTEGER",
        "c_acctbal": "DOUBLE", "c_mktsegment": "VARCHAR",
    },
    "supplier": {
        "s_suppkey": "BIGINT", "s_name": "VARCHAR", "s_nationkey": "INTEGER",
        "s_acctbal": "DOUBLE",
    },
    "part": {
        "p_partkey": "BIGINT", "p_name": "VARCHAR", "p_brand": "VARCHAR", "p_type": "VARCHAR",
        "p_size": "INTEGER", "p_retailprice": "DOUBLE",
    },
    "orders": {
        "o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR",
        "o_totalprice": "DOUBLE", "o_orderdate": "TIMESTAMP", "o_orderpriority": "VARCHAR",
    },
    "lineitem": {
        "l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT",
        "l_linenumber": "INTEGER", "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE",
        "l_discount": "DOUBLE", "l_tax": "DOUBLE", "l_returnflag": "VARCHAR",
        "l_linestatus": "VARCHAR", "l_shipdate": "TIMESTAMP",
    },
    "events": {
        "event_id": "BIGINT", "ts": "TIMESTAMP", "user_id": "BIGINT", "event_type": "VARCHAR",
        "value": "DOUBLE", "props": "VARCHAR",
    },
    "documents": {
        "doc_id": "BIGINT", "text": "VARCHAR", "lang": "VARCHAR", "source": "VARCHAR",
        "n_chars": "BIGINT",
    },
    "embeddings": {"vec_id": "BIGINT", "embedding": "FLOAT[]", "label": "INTEGER"},
    "pages": {"page_id": "BIGINT", "url": "VARCHAR", "html": "VARCHAR"},
    "benchmark": {"item_id": "BIGINT", "text": "VARCHAR"},
    "labels": {"doc_id": "BIGINT", "quality": "INTEGER", "toxic": "INTEGER"},
    "conversations": {
        "conv_id": "BIGINT", "turn": "BIGINT", "role": "VARCHAR", "text": "VARCHAR",
    },
}

TABLES = tuple(SCHEMAS)

# Spark's name for each column type of the given tables.
SPARK_TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Open a table with its known schema, which saves a job that would infer it."""
    ddl = ", ".join(f"`{c}` {SPARK_TYPES[t]}" for c, t in SCHEMAS[name].items())
    return spark.read.schema(ddl).parquet(f"{sf_dir}/{name}.parquet")


class Frames(Mapping[str, DataFrame]):
    """The tables of a directory, opened when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.root, self._open = spark, sf_dir.rstrip("/"), {}
        self._bytes: dict[str, int] = {}
        #: Views of lines with their orders, and of these grouped, where they are at hand.
        self.lines: str | None = None
        self.groups: str | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            if name not in SCHEMAS:
                raise KeyError(name)
            self._open[name] = load(self.spark, self.root, name)
        return self._open[name]

    def bytes(self, name: str) -> int:
        """Size of a table's files."""
        if name not in self._bytes:
            fs, path = SmallFiles(self.spark).at(f"{self.root}/{name}.parquet")
            self._bytes[name] = fs.getContentSummary(path).getLength()
        return self._bytes[name]

    def __iter__(self):
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)
