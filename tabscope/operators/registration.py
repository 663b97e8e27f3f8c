"""Registration: a dictionary snapshot becomes the profiling population.

The two masters are keyed by database, owner, table (and column). By default the
profile id belongs to the key as well, so that two profiles of one database do not
overwrite each other; ``per_profile=False`` leaves it out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.types import character_type_name
from tabscope.operators.dictionary.common import INDEX_SEGMENTS, MIB, TABLE_SEGMENTS, whole_units
from tabscope.operators.merge import upsert
from tabscope.operators.ranking import global_row_number
from tabscope.plans.spec import DEFAULT_PROFILE

# Degree of parallelism by table size in MB, work groups, columns per group.
PARALLELISM_TIERS = ((100000, 16), (50000, 8), (100, 4))
LOWEST_PARALLELISM = 2
TABLE_WORK_GROUPS = 3
COLUMNS_PER_GROUP = 30

#: What tables are joined by. Joins sort by the first key, and owners are few.
_TABLE_KEY = ("tab_nm", "owner_nm")

#: Column types of the masters, in order.
TABLE_MASTER = {
    "prfl_id": "string", "db_nm": "string", "owner_nm": "string", "tab_nm": "string",
    "tab_comment": "string", "use_yn": "string", "part_tab_yn": "string", "chasu": "int",
    "cr_dt": "timestamp_ntz", "up_dt": "timestamp_ntz", "col_cnt": "bigint",
    "tab_size": "bigint", "exec_dop": "int", "index_cnt": "bigint", "ind_size": "bigint",
    "tab_workgrp_no": "int", "tab_cnt": "bigint", "tabcnt_str_dt": "timestamp_ntz",
    "tabcnt_end_dt": "timestamp_ntz",
}
COLUMN_MASTER = {
    "prfl_id": "string", "db_nm": "string", "owner_nm": "string", "tab_nm": "string",
    "col_nm": "string", "col_comment": "string", "use_yn": "string", "chasu": "int",
    "col_seq": "int", "col_workgrp_no": "int", "pk_col_seq": "int", "col_data_type": "string",
    "col_data_length": "bigint", "null_yn": "string", "col_data_precision": "int",
    "col_data_scale": "int", "cr_dt": "timestamp_ntz", "up_dt": "timestamp_ntz",
    "colval_exec_typ": "string", "colpat_exec_typ": "string", "notnull_cnt": "bigint",
    "col_kind": "bigint", "max_col_val": "string", "min_col_val": "string", "max_len": "int",
    "sample_data": "string", "top_col_pat": "string",
}

# Refreshed when a registered row meets a newer dictionary; every other column stays.
TABLE_REFRESHED = (
    "part_tab_yn", "prfl_id", "use_yn", "chasu", "col_cnt", "tab_size", "exec_dop",
    "index_cnt", "ind_size", "tab_workgrp_no", "tab_comment",
)
COLUMN_REFRESHED = (
    "chasu", "col_seq", "col_workgrp_no", "col_data_type", "col_data_length", "null_yn",
    "col_data_precision", "col_data_scale", "pk_col_seq", "col_comment",
)


@dataclass(frozen=True)
class Snapshot:
    """The dictionary parts of one database and snapshot number."""

    tables: DataFrame
    columns: DataFrame
    segments: DataFrame
    constraints: DataFrame
    constraint_columns: DataFrame
    indexes: DataFrame

    def of(self, db_nm: str, chasu: int, schemas: Sequence[str]) -> "Snapshot":
        """Restrict every part to one snapshot and the listed schemas."""
        wanted = (
            (F.col("db_nm") == db_nm)
            & (F.col("chasu") == chasu)
            & F.col("owner_nm").isin(*schemas)
        )
        return Snapshot(
            **{name: getattr(self, name).filter(wanted) for name in self.__dataclass_fields__}
        )


def column_counts(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """``col_cnt`` of every table; a table without columns has zero."""
    counts = columns.groupBy(*_TABLE_KEY).agg(F.count(F.lit(1)).alias("col_cnt"))
    return (
        tables.select("owner_nm", "tab_nm")
        .join(counts, list(_TABLE_KEY), "left")
        .select(
            "owner_nm", "tab_nm",
            F.coalesce("col_cnt", F.lit(0).cast("bigint")).alias("col_cnt"),
        )
    )


def table_sizes(segments: DataFrame) -> DataFrame:
    """``tab_size``: whole MB over all segments of a table."""
    return (
        segments.filter(F.col("segment_type").isin(*TABLE_SEGMENTS))
        .groupBy(F.col("segment_nm").alias("tab_nm"), "owner_nm")
        .agg(F.sum("segment_size").alias("bytes"))
        .select("owner_nm", "tab_nm", whole_units(F.col("bytes"), MIB).alias("tab_size"))
    )


def parallelism(size_mb: Column) -> Column:
    """Degree of parallelism stored with a table. Advisory: Spark sizes its own tasks."""
    tier = None
    for floor_mb, degree in PARALLELISM_TIERS:
        tier = (
            F.when(size_mb >= floor_mb, degree) if tier is None
            else tier.when(size_mb >= floor_mb, degree)
        )
    return tier.otherwise(LOWEST_PARALLELISM)


def index_stats(segments: DataFrame, indexes: DataFrame, by_index: bool = False) -> DataFrame:
    """``index_cnt`` and ``ind_size`` (MB) per table.

    The default matches an index segment to the *table* of the same name, which is what
    the profile tables hold and is zero unless an index is named like its table.
    ``by_index`` finds the segments of a table's indexes by the index name.
    """
    key = list(_TABLE_KEY)
    if by_index:
        sizes = (
            segments.filter(F.col("segment_type").isin(*INDEX_SEGMENTS))
            .groupBy(F.col("segment_nm").alias("index_nm"), "owner_nm")
            .agg(F.sum("segment_size").alias("bytes"))
        )
        per_table = (
            indexes.select(*key, "index_nm")
            .join(sizes, ["index_nm", "owner_nm"], "left")
            .groupBy(*key)
            .agg(F.count(F.lit(1)).alias("index_cnt"), F.sum("bytes").alias("bytes"))
        )
    else:
        counts = indexes.groupBy(*key).agg(F.count(F.lit(1)).alias("index_cnt"))
        per_table = (
            segments.filter(F.col("segment_type") == INDEX_SEGMENTS[0])
            .groupBy(F.col("segment_nm").alias("tab_nm"), "owner_nm")
            .agg(F.sum("segment_size").alias("bytes"))
            .join(counts, key, "left")
        )
    return per_table.select(
        "owner_nm", "tab_nm",
        F.coalesce("index_cnt", F.lit(0)).alias("index_cnt"),
        whole_units(F.col("bytes"), MIB).alias("ind_size"),
    )


def work_groups(sized: DataFrame) -> DataFrame:
    """``tab_workgrp_no``: tables dealt to three groups, largest first.

    Expects ``owner_nm``, ``tab_nm`` and ``tab_size``; ties go by owner and table.
    """
    numbered = global_row_number(
        sized, [F.desc("tab_size"), F.asc("owner_nm"), F.asc("tab_nm")], "rn"
    )
    group = (F.col("rn") % TABLE_WORK_GROUPS + 1).cast("int")
    return numbered.withColumn("tab_workgrp_no", group).drop("rn")


def column_work_group(col_seq: Column) -> Column:
    return (F.floor(col_seq / COLUMNS_PER_GROUP) + 1).cast("int")


def primary_key_positions(
    columns: DataFrame, constraints: DataFrame, constraint_columns: DataFrame
) -> DataFrame:
    """Columns with ``pk_col_seq``, their place in the primary key or NULL.

    Keys are found by table and name, since tables may share constraint names.
    """
    key = [*_TABLE_KEY, "cons_nm"]
    named = F.col("table_nm").alias("tab_nm")
    primary = constraints.filter(F.col("cons_type") == "P").select("owner_nm", named, "cons_nm")
    members = (
        constraint_columns.select("owner_nm", named, "cons_nm", "col_nm", "pos")
        .join(primary, key)
        .select("owner_nm", "tab_nm", "col_nm", F.col("pos").alias("pk_col_seq"))
    )
    front = ["owner_nm", "tab_nm", "col_nm"]
    placed = columns.join(members, [*_TABLE_KEY, "col_nm"], "left")
    return placed.select(*front, *[c for c in placed.columns if c not in front])


def _typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.select(
        *[
            (F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n)
            for n, t in types.items()
        ]
    )


def table_population(
    snapshot: Snapshot,
    run_ts: dt.datetime,
    prfl_id: str = DEFAULT_PROFILE,
    index_by_name: bool = False,
) -> DataFrame:
    """Table rows as a first registration inserts them."""
    key = list(_TABLE_KEY)
    zero = F.lit(0).cast("bigint")
    # Only the keys and sizes go through the ranking.
    placed = work_groups(
        snapshot.tables.select(*key)
        .join(table_sizes(snapshot.segments), key, "left")
        .select(*key, F.coalesce("tab_size", zero).alias("tab_size"))
    )
    sized = (
        snapshot.tables.join(placed, key)
        .join(column_counts(snapshot.tables, snapshot.columns), key, "left")
        .join(index_stats(snapshot.segments, snapshot.indexes, index_by_name), key, "left")
    )
    named = sized.select(
        "*",
        F.lit(prfl_id).alias("prfl_id"),
        F.lit("Y").alias("use_yn"),
        F.col("part_yn").alias("part_tab_yn"),
        parallelism(F.col("tab_size")).alias("exec_dop"),
    )
    filled = named.withColumns(
        {
            "index_cnt": F.coalesce("index_cnt", zero),
            "ind_size": F.coalesce("ind_size", zero),
            "cr_dt": F.lit(run_ts).cast("timestamp_ntz"),
        }
    )
    return _typed(filled, TABLE_MASTER)


def column_population(
    snapshot: Snapshot, run_ts: dt.datetime, prfl_id: str = DEFAULT_PROFILE
) -> DataFrame:
    """Column rows as a first registration inserts them, without default flags."""
    placed = primary_key_positions(
        snapshot.columns, snapshot.constraints, snapshot.constraint_columns
    )
    named = placed.select(
        *[c for c in placed.columns if c != "cr_dt"],
        F.lit(prfl_id).alias("prfl_id"),
        F.lit("Y").alias("use_yn"),
        column_work_group(F.col("col_seq")).alias("col_workgrp_no"),
        F.col("data_type").alias("col_data_type"),
        F.col("data_len").alias("col_data_length"),
        F.col("data_precision").alias("col_data_precision"),
        F.col("data_scale").alias("col_data_scale"),
        F.lit(run_ts).cast("timestamp_ntz").alias("cr_dt"),
    )
    return _typed(named, COLUMN_MASTER)


def upsert_tables(
    existing: DataFrame, incoming: DataFrame, run_ts: dt.datetime, per_profile: bool = True
) -> DataFrame:
    """Merge table rows. Sizes, counts and the use flag are reset; results are kept."""
    key = [*_TABLE_KEY, "db_nm"] + (["prfl_id"] if per_profile else [])
    stamp = {"up_dt": F.lit(run_ts).cast("timestamp_ntz")}
    return upsert(existing, incoming, key, TABLE_REFRESHED, stamp)


def upsert_columns(
    existing: DataFrame, incoming: DataFrame, run_ts: dt.datetime, per_profile: bool = True
) -> DataFrame:
    """Merge column rows. Types and places are refreshed; flags and results are kept."""
    key = [*_TABLE_KEY, "col_nm", "db_nm"] + (["prfl_id"] if per_profile else [])
    stamp = {"up_dt": F.lit(run_ts).cast("timestamp_ntz")}
    return upsert(existing, incoming, key, COLUMN_REFRESHED, stamp)


def default_flag(
    column_master: DataFrame, flag: str, db_nm: str, prfl_id: str, run_ts: dt.datetime
) -> DataFrame:
    """Switch ``flag`` on for text columns of the profile where it was never set."""
    due = (
        (F.col("db_nm") == db_nm)
        & (F.col("prfl_id") == prfl_id)
        & F.col(flag).isNull()
        & character_type_name(F.col("col_data_type"))
    )
    return column_master.withColumns(
        {
            flag: F.when(due, "Y").otherwise(F.col(flag)),
            "up_dt": F.when(due, F.lit(run_ts).cast("timestamp_ntz")).otherwise(F.col("up_dt")),
        }
    )


def default_value_flag(
    column_master: DataFrame, db_nm: str, prfl_id: str, run_ts: dt.datetime
) -> DataFrame:
    return default_flag(column_master, "colval_exec_typ", db_nm, prfl_id, run_ts)


def default_pattern_flag(
    column_master: DataFrame, db_nm: str, prfl_id: str, run_ts: dt.datetime
) -> DataFrame:
    return default_flag(column_master, "colpat_exec_typ", db_nm, prfl_id, run_ts)


def register(
    snapshot: Snapshot,
    table_master: DataFrame,
    column_master: DataFrame,
    db_nm: str,
    run_ts: dt.datetime,
    prfl_id: str = DEFAULT_PROFILE,
    per_profile: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The two masters after registering one snapshot."""
    tables = upsert_tables(
        table_master, table_population(snapshot, run_ts, prfl_id), run_ts, per_profile
    )
    columns = upsert_columns(
        column_master, column_population(snapshot, run_ts, prfl_id), run_ts, per_profile
    )
    columns = default_value_flag(columns, db_nm, prfl_id, run_ts)
    columns = default_pattern_flag(columns, db_nm, prfl_id, run_ts)
    return tables, columns
