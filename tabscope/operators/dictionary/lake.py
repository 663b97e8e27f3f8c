"""Dictionary of a lake directory: tables, columns and files as segments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.operators.dictionary.common import (
    DICTIONARY_TYPES,
    GIB,
    MIB,
    NO_PARTITION,
    shaped,
    whole_units,
)

_SCHEMA_COLUMNS = (
    "tab_nm", "col_nm", "col_seq", "data_type", "null_yn", "data_precision", "data_scale",
)


def columns(
    spark: SparkSession, frames: Mapping[str, DataFrame], owner_nm: str = "main"
) -> DataFrame:
    """One row per column of every table, from the table schemas alone."""
    rows = [
        (
            tab_nm,
            f.name,
            seq,
            f.dataType.simpleString(),
            "Y" if f.nullable else "N",
            f.dataType.precision if isinstance(f.dataType, T.DecimalType) else None,
            f.dataType.scale if isinstance(f.dataType, T.DecimalType) else None,
        )
        for tab_nm, frame in frames.items()
        for seq, f in enumerate(frame.schema.fields, start=1)
    ]
    types = DICTIONARY_TYPES["columns"]
    return shaped(
        spark.createDataFrame(rows, ", ".join(f"{c} {types[c]}" for c in _SCHEMA_COLUMNS)),
        "columns",
        owner_nm=F.lit(owner_nm),
        col_comment=F.lit(""),
        **{c: F.col(c) for c in _SCHEMA_COLUMNS},
    )


def measured(column_rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Column rows with what the data shows: longest text and whether NULLs occur.

    A lake declares neither a length nor, as a rule, a NULL constraint. ``stats`` are
    column statistics with row counts; columns without them keep their declaration.
    """
    key = ["owner_nm", "tab_nm", "col_nm"]
    facts = stats.select(
        *key,
        F.col("max_len").cast("bigint").alias("_len"),
        F.when(F.col("notnull_cnt") < F.col("tab_cnt"), "Y").otherwise("N").alias("_null_yn"),
    )
    joined = column_rows.join(facts, key, "left").withColumns(
        {"data_len": F.coalesce("_len", "data_len"), "null_yn": F.coalesce("_null_yn", "null_yn")}
    )
    return joined.select(*column_rows.columns)


def segments(
    spark: SparkSession, root: str, owner_nm: str = "main", suffix: str = ".parquet"
) -> DataFrame:
    """One row per data file below ``root``; only file status is read, no content.

    A table is the first path step below the root: a file, or a directory of files
    whose names become partitions.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
        .select("path", "length")
    )
    base = root.rstrip("/").split("/")[-1]
    steps = F.split(F.substring_index("path", f"/{base}/", -1), "/")
    in_directory = F.size(steps) > 1
    table = F.regexp_replace(F.element_at(steps, 1), suffix.replace(".", r"\.") + "$", "")
    return shaped(
        files,
        "segments",
        owner_nm=F.lit(owner_nm),
        segment_nm=table,
        partition_nm=F.when(
            in_directory, F.array_join(F.slice(steps, F.lit(2), F.size(steps)), "/")
        ).otherwise(NO_PARTITION),
        segment_type=F.when(in_directory, "TABLE PARTITION").otherwise("TABLE"),
        head_block_cnt=F.lit(0),
        segment_size=F.col("length"),
        block_cnt=F.lit(0),
    )


def partition_segments(
    spark: SparkSession, root: str, owner_nm: str = "main", suffix: str = ""
) -> DataFrame:
    """One row per partition of the tables below ``root``, whatever the format of the files.

    A partition is a directory whose steps below the table's read ``column=value``; its
    name are these steps with their values decoded. Files of a table that lie in no such
    directory are one segment of the whole table. Names that start with ``_`` or ``.`` are
    not data. ``block_cnt`` counts the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split("/")[-1]
    listed = files.select(
        F.split(F.substring_index("path", f"/{base}/", -1), "/").alias("steps"), "length"
    )
    folders = F.slice("steps", F.lit(2), F.greatest(F.size("steps") - 2, F.lit(0)))
    keyed = F.filter(folders, lambda s: s.contains("="))
    decoded = F.transform(keyed, lambda s: F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B"))))
    name = F.when(F.size(keyed) > 0, F.array_join(decoded, "/"))
    hidden = F.exists("steps", lambda s: s.startswith("_") | s.startswith("."))
    # A table that is a single file is named without the file's suffix.
    first = F.element_at("steps", 1)
    table = F.when(F.size("steps") > 1, first).otherwise(F.regexp_replace(first, r"\.[^.]*$", ""))
    found = (
        listed.where(~hidden & F.element_at("steps", -1).endswith(suffix))
        .groupBy(table.alias("tab"), name.alias("part"))
        .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).cast("int").alias("files"))
    )
    return shaped(
        found,
        "segments",
        owner_nm=F.lit(owner_nm),
        segment_nm=F.col("tab"),
        partition_nm=F.coalesce("part", F.lit(NO_PARTITION)),
        segment_type=F.when(F.col("part").isNotNull(), "TABLE PARTITION").otherwise("TABLE"),
        head_block_cnt=F.lit(0),
        segment_size=F.col("bytes"),
        block_cnt=F.col("files"),
    )


def tables(segment_rows: DataFrame, row_counts: DataFrame | None = None) -> DataFrame:
    """Tables of the lake, sized by their files; row counts where they are known."""
    per_table = segment_rows.groupBy("owner_nm", F.col("segment_nm").alias("tab_nm")).agg(
        F.sum("segment_size").alias("bytes"),
        F.max(F.col("segment_type") == "TABLE PARTITION").alias("partitioned"),
    )
    if row_counts is None:
        counted = per_table.withColumn("tab_cnt", F.lit(None).cast("bigint"))
    else:
        counted = per_table.join(
            row_counts.select("owner_nm", "tab_nm", "tab_cnt"), ["owner_nm", "tab_nm"], "left"
        )
    return shaped(
        counted,
        "tables",
        owner_nm=F.col("owner_nm"),
        tab_nm=F.col("tab_nm"),
        tab_comment=F.lit(""),
        row_cnt=F.col("tab_cnt"),
        part_yn=F.when(F.col("partitioned"), "Y").otherwise("N"),
        tab_mb_size=whole_units(F.col("bytes"), MIB),
        tab_gb_size=whole_units(F.col("bytes"), GIB),
    )


def empty(spark: SparkSession, kind: str) -> DataFrame:
    """An empty dictionary part: files carry no constraints and no indexes."""
    fields = ", ".join(f"{n} {t}" for n, t in DICTIONARY_TYPES[kind].items())
    return spark.createDataFrame([], fields)
