"""Registration over the derived dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators import registration as reg
from tabscope.operators.dictionary.snapshot import latest_snapshot
from tabscope.pipeline import collect_dictionary, register_population
from tabscope.plans.spec import profile_targets
from verification.catalogs import DB, KEPT, extract, lines_at_hand, with_extracts
from verification.checked import Check, comparable, sql_stamp
from verification.inputs import RUN_TS, scratch_store
from verification.tables import Frames

_PARTS = tuple(reg.Snapshot.__dataclass_fields__)
_DIC = tuple(f"dic_{p}" for p in _PARTS)
_IN = "(" + ", ".join(f"'{s}'" for s in KEPT) + ")"
_RUN = "'2026-01-02 03:04:05'"


def _all_parts(frames: Frames) -> reg.Snapshot:
    return reg.Snapshot(**{p: extract(frames, f"dic_{p}") for p in _PARTS})


def derived(frames: Frames) -> reg.Snapshot:
    return _all_parts(frames).of(DB, 2, KEPT)


def _master(frames: Frames, name: str, types: dict[str, str]) -> DataFrame:
    """An earlier registration, in the full shape of its master."""
    old = extract(frames, name)
    return old.select(
        *[
            (F.col(c) if c in old.columns else F.lit(None)).cast(t).alias(c)
            for c, t in types.items()
        ]
    )


_SIZES = f"""
tab AS (SELECT * FROM dic_tables WHERE owner_nm IN {_IN}),
tab_bytes AS (
    SELECT owner_nm, segment_nm AS tab_nm, sum(segment_size)::BIGINT // 1048576 AS tab_size
    FROM dic_segments WHERE segment_type IN ('TABLE', 'TABLE PARTITION') GROUP BY ALL
),
col_no AS (SELECT owner_nm, tab_nm, count(*) AS col_cnt FROM dic_columns GROUP BY ALL),
ind_no AS (SELECT owner_nm, tab_nm, count(*) AS index_cnt FROM dic_indexes GROUP BY ALL),
ind_bytes AS (
    SELECT owner_nm, segment_nm AS tab_nm, sum(segment_size)::BIGINT // 1048576 AS ind_size
    FROM dic_segments WHERE segment_type = 'INDEX' GROUP BY ALL
),
sized AS (
    SELECT tab.*, ifnull(tab_size, 0) AS tab_size, ifnull(col_cnt, 0) AS col_cnt,
           if(ind_bytes.tab_nm IS NULL, 0, ifnull(index_cnt, 0)) AS index_cnt,
           ifnull(ind_size, 0) AS ind_size
    FROM tab LEFT JOIN tab_bytes USING (owner_nm, tab_nm) LEFT JOIN col_no USING (owner_nm, tab_nm)
    LEFT JOIN ind_no USING (owner_nm, tab_nm) LEFT JOIN ind_bytes USING (owner_nm, tab_nm)
),
fresh AS (
    SELECT *, CASE WHEN tab_size < 100 THEN 2 WHEN tab_size < 50000 THEN 4
                   WHEN tab_size < 100000 THEN 8 ELSE 16 END AS exec_dop,
           row_number() OVER (ORDER BY tab_size DESC, owner_nm, tab_nm) % 3 + 1 AS tab_workgrp_no
    FROM sized
)"""
_TABLE_OUT = (
    "prfl_id", "db_nm", "owner_nm", "tab_nm", "tab_comment", "use_yn", "part_tab_yn", "chasu",
    "cr_dt", "up_dt", "col_cnt", "tab_size", "exec_dop", "index_cnt", "ind_size",
    "tab_workgrp_no", "tab_cnt",
)
_COLUMN_OUT = (
    "prfl_id", "db_nm", "owner_nm", "tab_nm", "col_nm", "col_comment", "use_yn", "chasu",
    "col_seq", "col_workgrp_no", "pk_col_seq", "col_data_type", "col_data_length", "null_yn",
    "col_data_precision", "col_data_scale", "cr_dt", "up_dt", "colval_exec_typ",
    "colpat_exec_typ", "notnull_cnt",
)


def _table_upsert_sql(per_profile: bool) -> str:
    match = " AND o.prfl_id = 'P01'" if per_profile else ""
    profile = "coalesce(o.prfl_id, 'P01')" if per_profile else "if(n.tab_nm IS NULL, o.prfl_id, 'P01')"
    pick = lambda new, old: f"if(n.tab_nm IS NULL, {old}, {new})"
    return f"""
WITH {_SIZES}
SELECT {profile} AS prfl_id, '{DB}' AS db_nm, ifnull(n.owner_nm, o.owner_nm) AS owner_nm,
       ifnull(n.tab_nm, o.tab_nm) AS tab_nm, {pick('n.tab_comment', 'o.tab_comment')} AS tab_comment,
       {pick("'Y'", 'o.use_yn')} AS use_yn, n.part_yn AS part_tab_yn,
       {pick('2', 'o.chasu')} AS chasu,
       if(o.tab_nm IS NULL, {_RUN}, {sql_stamp('o.cr_dt')}) AS cr_dt,
       if(n.tab_nm IS NOT NULL AND o.tab_nm IS NOT NULL, {_RUN}, NULL) AS up_dt,
       n.col_cnt, n.tab_size, n.exec_dop, n.index_cnt, n.ind_size,
       CAST(n.tab_workgrp_no AS INTEGER) AS tab_workgrp_no, o.tab_cnt
FROM fresh n FULL JOIN old_tables o
  ON o.owner_nm = n.owner_nm AND o.tab_nm = n.tab_nm{match}"""


_PK = """
pk AS (
    SELECT m.owner_nm, k.table_nm AS tab_nm, m.col_nm, m.pos AS pk_col_seq
    FROM dic_constraints k JOIN dic_constraint_columns m USING (owner_nm, table_nm, cons_nm)
    WHERE k.cons_type = 'P'
)"""


def _column_upsert_sql(per_profile: bool, flags: bool, old: bool = True) -> str:
    match = " AND o.prfl_id = 'P01'" if per_profile else ""
    source = "old_columns" if old else "(SELECT * FROM old_columns WHERE false)"
    new = "n.col_nm IS NULL"
    merged = f"""
    SELECT ifnull(o.prfl_id, 'P01') AS prfl_id, '{DB}' AS db_nm,
           ifnull(n.owner_nm, o.owner_nm) AS owner_nm, ifnull(n.tab_nm, o.tab_nm) AS tab_nm,
           ifnull(n.col_nm, o.col_nm) AS col_nm, if({new}, o.col_comment, n.col_comment) AS col_comment,
           ifnull(o.use_yn, 'Y') AS use_yn, if({new}, o.chasu, 2) AS chasu, n.col_seq,
           n.col_seq // 30 + 1 AS col_workgrp_no, pk_col_seq,
           if({new}, o.col_data_type, n.data_type) AS col_data_type, n.data_len AS col_data_length,
           n.null_yn, n.data_precision AS col_data_precision, n.data_scale AS col_data_scale,
           ifnull({sql_stamp('o.cr_dt')}, {_RUN}) AS cr_dt,
           if(n.col_nm IS NOT NULL AND o.col_nm IS NOT NULL, {_RUN}, NULL) AS up_dt,
           o.colval_exec_typ, CAST(NULL AS VARCHAR) AS colpat_exec_typ, o.notnull_cnt
    FROM (SELECT * FROM dic_columns LEFT JOIN pk USING (owner_nm, tab_nm, col_nm)
          WHERE owner_nm IN {_IN}) n
    FULL JOIN {source} o
      ON (o.owner_nm, o.tab_nm, o.col_nm) = (n.owner_nm, n.tab_nm, n.col_nm){match}"""
    if not flags:
        return f"WITH {_PK.strip()}, merged AS ({merged}) SELECT * FROM merged"
    text = "prfl_id = 'P01' AND upper(col_data_type) IN ('VARCHAR2', 'STRING')"
    return f"""
WITH {_PK.strip()}, merged AS ({merged})
SELECT * REPLACE (
    if({text}, {_RUN}, up_dt) AS up_dt,
    if({text} AND colval_exec_typ IS NULL, 'Y', colval_exec_typ) AS colval_exec_typ,
    if({text}, 'Y', NULL) AS colpat_exec_typ
) FROM merged"""


def _flagged_sql(flag: str) -> str:
    return f"""
SELECT prfl_id, owner_nm, tab_nm, col_nm, data_type AS col_data_type,
       if(upper(data_type) IN ('VARCHAR2', 'STRING'), 'Y', NULL) AS {flag}
FROM (SELECT 'P01' AS prfl_id, * FROM dic_columns WHERE owner_nm IN {_IN})"""


def _registered(frames: Frames) -> DataFrame:
    """Collect a dictionary, register it; the column master that is left."""
    store = scratch_store(frames)
    with lines_at_hand(frames, *_DIC) as joined:
        parts = derived(joined)
        names = {p: getattr(parts, p).drop("chasu", "db_nm") for p in _PARTS}
        shaped = {
            p: df.select(
                *[
                    (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                    for c, t in _types(p).items()
                ]
            )
            for p, df in names.items()
        }
        collect_dictionary(frames.spark, store, DB, shaped, RUN_TS, chasu=2)
    register_population(store, DB, KEPT, RUN_TS)
    return comparable(store.master("column_master"), *_COLUMN_OUT)


def _types(part: str) -> dict[str, str]:
    from tabscope.operators.dictionary.common import DICTIONARY_TYPES

    return DICTIONARY_TYPES[part]


def checks() -> dict[str, Check]:
    def sizes(frames: Frames) -> DataFrame:
        snap = derived(frames)
        return (
            snap.tables.select("owner_nm", "tab_nm")
            .join(reg.table_sizes(snap.segments), ["owner_nm", "tab_nm"], "left")
            .withColumn("tab_size", F.coalesce("tab_size", F.lit(0).cast("bigint")))
        )

    def flagged(flag_fn, flag: str):
        def build(frames: Frames) -> DataFrame:
            columns = reg.column_population(derived(frames), RUN_TS)
            return flag_fn(columns, DB, "P01", RUN_TS).select(
                "prfl_id", "owner_nm", "tab_nm", "col_nm", "col_data_type", flag
            )

        return Check(build, with_extracts(("dic_columns",), _flagged_sql(flag)))

    def tables_upsert(per_profile: bool) -> Check:
        return Check(
            lambda frames: comparable(
                reg.upsert_tables(
                    _master(frames, "old_tables", reg.TABLE_MASTER),
                    reg.table_population(derived(frames), RUN_TS),
                    RUN_TS,
                    per_profile,
                ),
                *_TABLE_OUT,
            ),
            with_extracts((*_DIC, "old_tables"), _table_upsert_sql(per_profile)),
        )

    def columns_upsert(per_profile: bool) -> Check:
        return Check(
            lambda frames: comparable(
                reg.upsert_columns(
                    _master(frames, "old_columns", reg.COLUMN_MASTER),
                    reg.column_population(derived(frames), RUN_TS),
                    RUN_TS,
                    per_profile,
                ),
                *_COLUMN_OUT,
            ),
            with_extracts((*_DIC, "old_columns"), _column_upsert_sql(per_profile, flags=False)),
        )

    return {
        "reg_latest_snapshot": Check(
            lambda frames: latest_snapshot(extract(frames, "dic_snapshots"), DB),
            with_extracts(("dic_snapshots",), "SELECT max(chasu) AS chasu FROM dic_snapshots"),
        ),
        "reg_column_count": Check(
            lambda frames: reg.column_counts(derived(frames).tables, derived(frames).columns),
            with_extracts(
                ("dic_tables", "dic_columns"),
                f"""SELECT t.owner_nm, t.tab_nm, count(c.col_nm) AS col_cnt
FROM dic_tables t LEFT JOIN dic_columns c USING (owner_nm, tab_nm)
WHERE t.owner_nm IN {_IN} GROUP BY ALL""",
            ),
        ),
        "reg_table_size_mb": Check(
            lambda frames: reg.table_sizes(derived(frames).segments),
            with_extracts(
                ("dic_segments",),
                f"""SELECT owner_nm, segment_nm AS tab_nm,
       CAST(sum(segment_size) // 1048576 AS BIGINT) AS tab_size
FROM dic_segments WHERE segment_type LIKE 'TABLE%' AND owner_nm IN {_IN} GROUP BY ALL""",
            ),
        ),
        "reg_dop_tier": Check(
            lambda frames: sizes(frames).withColumn("exec_dop", reg.parallelism(F.col("tab_size"))),
            with_extracts(
                _DIC,
                f"WITH {_SIZES} SELECT owner_nm, tab_nm, tab_size, exec_dop FROM fresh",
            ),
        ),
        "reg_index_stats_faithful": Check(
            lambda frames: reg.index_stats(derived(frames).segments, derived(frames).indexes),
            with_extracts(
                ("dic_segments", "dic_indexes"),
                f"""SELECT s.owner_nm, s.segment_nm AS tab_nm,
       (SELECT count(*) FROM dic_indexes i
        WHERE i.owner_nm = s.owner_nm AND i.tab_nm = s.segment_nm) AS index_cnt,
       CAST(sum(s.segment_size) // 1048576 AS BIGINT) AS ind_size
FROM dic_segments s WHERE s.segment_type = 'INDEX' AND s.owner_nm IN {_IN}
GROUP BY s.owner_nm, s.segment_nm""",
            ),
        ),
        "reg_index_stats_by_index": Check(
            lambda frames: reg.index_stats(
                derived(frames).segments, derived(frames).indexes, by_index=True
            ),
            with_extracts(
                ("dic_segments", "dic_indexes"),
                f"""SELECT i.owner_nm, i.tab_nm, count(DISTINCT i.index_nm) AS index_cnt,
       CAST(ifnull(sum(s.segment_size), 0) // 1048576 AS BIGINT) AS ind_size
FROM dic_indexes i LEFT JOIN dic_segments s
  ON s.owner_nm = i.owner_nm AND s.segment_nm = i.index_nm
  AND s.segment_type IN ('INDEX', 'INDEX PARTITION')
WHERE i.owner_nm IN {_IN} GROUP BY i.owner_nm, i.tab_nm""",
            ),
        ),
        "reg_table_workgroup": Check(
            lambda frames: reg.work_groups(sizes(frames)),
            with_extracts(
                _DIC,
                f"""WITH {_SIZES}
SELECT owner_nm, tab_nm, tab_size, CAST(tab_workgrp_no AS INTEGER) AS tab_workgrp_no FROM fresh""",
            ),
        ),
        "reg_table_upsert": tables_upsert(per_profile=False),
        "reg_table_upsert_by_profile": tables_upsert(per_profile=True),
        "reg_pk_position": Check(
            lambda frames: reg.primary_key_positions(
                derived(frames).columns,
                derived(frames).constraints,
                derived(frames).constraint_columns,
            ).select("owner_nm", "tab_nm", "col_nm", "pk_col_seq"),
            with_extracts(
                ("dic_columns", "dic_constraints", "dic_constraint_columns"),
                f"""WITH {_PK.strip()}
SELECT owner_nm, tab_nm, col_nm, pk_col_seq
FROM dic_columns LEFT JOIN pk USING (owner_nm, tab_nm, col_nm) WHERE owner_nm IN {_IN}""",
            ),
        ),
        "reg_column_workgroup": Check(
            lambda frames: derived(frames).columns.select(
                "owner_nm", "tab_nm", "col_nm", "col_seq",
                reg.column_work_group(F.col("col_seq")).alias("col_workgrp_no"),
            ),
            with_extracts(
                ("dic_columns",),
                f"""SELECT owner_nm, tab_nm, col_nm, col_seq, col_seq // 30 + 1 AS col_workgrp_no
FROM dic_columns WHERE owner_nm IN {_IN}""",
            ),
        ),
        "reg_column_upsert": columns_upsert(per_profile=False),
        "reg_column_upsert_by_profile": columns_upsert(per_profile=True),
        "reg_default_value_flag": flagged(reg.default_value_flag, "colval_exec_typ"),
        "reg_default_pattern_flag": flagged(reg.default_pattern_flag, "colpat_exec_typ"),
        "reg_register_all": Check(
            _registered,
            with_extracts(
                (*_DIC, "old_columns"), _column_upsert_sql(True, flags=True, old=False)
            ),
        ),
        "profile_targets": Check(
            lambda frames: profile_targets(
                _master(frames, "old_tables", reg.TABLE_MASTER), DB, "P01"
            ),
            with_extracts(
                ("old_tables",),
                "SELECT owner_nm, tab_nm FROM old_tables WHERE prfl_id = 'P01' AND use_yn = 'Y'",
            ),
        ),
    }
