"""The profile levels over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.patterns import char_pattern
from tabscope.functions.buckets import VALUE_CHARS
from tabscope.operators.column_stats import EXTREME_CHARS, column_stats, distinct_counts
from tabscope.operators.merge import update_by_key
from tabscope.operators.pattern_dist import (
    pattern_counts_direct,
    pattern_counts_from_values,
    patterns_direct,
    patterns_from_values,
    top_pattern,
)
from tabscope.operators import incremental, remote
from tabscope.operators.heavy import sample_values_bounded, top_pattern_bounded
from tabscope.operators.registration import column_population
from tabscope.operators.report import profile_report
from tabscope.operators.dictionary import lake
from tabscope.operators.registration import Snapshot
from tabscope.operators.sketches import distinct_sketches, estimates, union_sketches
from tabscope.operators.table_stats import row_counts
from tabscope.operators.value_dist import numbered_histogram, sample_values, value_histogram
from tabscope.pipeline import STAT_COLUMNS, Profiler, collect_dictionary, register_population
from tabscope.plans.packing import packed
from tabscope.plans.spec import COLUMN_KEY, ProfileInput, name_columns
from tabscope.session import shared_dir
from tabscope.sources.lake_files import LakeTable
from tabscope.sources.registry import SourceRegistry, adhoc_query
from verification import profile_sql as sql
from verification.checked import Check
from verification.inputs import (
    DECIMALS, RUN_TS, inputs, profile_input, remote_input, scratch_store,
)
from verification.tables import SCHEMAS, TABLES, Frames

def _short(df: DataFrame) -> DataFrame:
    """Without the constant parts of the key."""
    return df.drop("db_nm", "owner_nm", "prfl_id")


def _stats(*names: str) -> Check:
    return Check(
        lambda frames: _short(column_stats(inputs(frames, *names))),
        sql.union(sql.stats(n) for n in names),
    )


def _values(table: str, modes: Mapping[str, str], **options) -> Check:
    """A histogram of whole values, unless a width is the point of the query."""
    chars = options.pop("value_chars", None)
    return Check(
        lambda frames: _short(
            value_histogram(
                [profile_input(frames[table], table, modes)], value_chars=chars, **options
            )
        ),
        sql.values(table, modes, chars),
    )


def _patterns(table: str, chars: int | None = None, **options) -> Check:
    return Check(
        lambda frames: _short(
            patterns_direct(inputs(frames, table), value_chars=chars, **options)
        ),
        sql.shared(sql.patterns(table, chars=chars)),
    )


_ORDER_MODES = {
    "o_orderstatus": "Y", "o_orderpriority": "Y", "o_orderdate": "A", "o_totalprice": "B",
}
_LINE_MODES = {
    "l_returnflag": "Y", "l_linestatus": "Y", "l_shipdate": "A", "l_extendedprice": "B",
    "l_tax": "B",
}
_EVENT_MODES = {"event_type": "Y", "ts": "A", "value": "B", "props": "Y"}
_TEXT_TABLES = tuple(t for t in TABLES if sql.text_columns(t))


def _column_checks() -> dict[str, Check]:
    out = {
        f"column_stats_{t}": _stats(t)
        for t in (
            "orders", "lineitem", "customer", "part", "events", "documents", "embeddings",
        )
    }
    out["column_stats_all"] = _stats(*TABLES)
    out["column_stats_documents_4000"] = Check(
        lambda frames: _short(
            column_stats(inputs(frames, "documents"), extreme_chars=EXTREME_CHARS)
        ),
        sql.stats("documents", EXTREME_CHARS),
    )
    out["column_distinct_counts"] = Check(
        lambda frames: _short(distinct_counts(inputs(frames, *TABLES))),
        f"SELECT tab_nm, col_nm, col_kind FROM ({sql.union(map(sql.stats, TABLES))})",
    )
    out["table_row_counts"] = Check(
        lambda frames: _short(row_counts(inputs(frames, *TABLES))),
        sql.union(f"SELECT '{t}' AS tab_nm, count(*) AS tab_cnt FROM {t}" for t in TABLES),
    )
    return out


def _value_checks() -> dict[str, Check]:
    def with_nulls(frames: Frames) -> DataFrame:
        """Two order columns in which one value each has become NULL."""
        holed = frames["orders"].select(
            F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"),
            F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        )
        return _short(value_histogram([profile_input(holed, "orders")]))

    def months(frames: Frames) -> DataFrame:
        return _short(
            value_histogram(
                [
                    profile_input(frames["orders"], "orders", {"o_orderdate": "A"}),
                    profile_input(frames["lineitem"], "lineitem", {"l_shipdate": "A"}),
                    profile_input(frames["events"], "events", {"ts": "A"}),
                ],
                months=True,
            )
        )

    def range_columns(frames: Frames, rounded: bool) -> DataFrame:
        picked = {
            "customer": {"c_acctbal": "B"}, "orders": {"o_totalprice": "B"},
            "lineitem": {"l_tax": "B", "l_extendedprice": "B"}, "events": {"value": "B"},
            "part": {"p_size": "B"},
        }
        return _short(
            value_histogram(
                [profile_input(frames[t], t, m) for t, m in picked.items()], rounded=rounded
            )
        )

    def range_sql(rounded: bool) -> str:
        picked = (
            ("customer", "c_acctbal"), ("orders", "o_totalprice"), ("lineitem", "l_tax"),
            ("lineitem", "l_extendedprice"), ("events", "value"), ("part", "p_size"),
        )
        return sql.union(sql.values(t, {c: "B"}, rounded=rounded) for t, c in picked)

    month_sql = sql.union(
        f"SELECT '{t}' AS tab_nm, '{c}' AS col_nm, strftime({c}, '%Y%m') AS col_val, "
        f"count(*) AS col_val_cnt FROM {t} GROUP BY 3"
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    )
    nulls_sql = sql.union(
        f"SELECT 'orders' AS tab_nm, '{c}' AS col_nm, if({c} = '{v}', '##', {c}) AS col_val, "
        f"count(*) AS col_val_cnt FROM orders GROUP BY 3"
        for c, v in (("o_orderpriority", "1-URGENT"), ("o_orderstatus", "P"))
    )
    all_modes = {t: sql.default_modes(t) for t in _TEXT_TABLES}
    all_values = sql.union(sql.values(t, m, chars=None) for t, m in all_modes.items())

    def every(frames: Frames) -> DataFrame:
        return value_histogram(inputs(frames, *_TEXT_TABLES))

    def samples(frames: Frames) -> DataFrame:
        histogram, groups = numbered_histogram(inputs(frames, *_TEXT_TABLES))
        return _short(name_columns(sample_values(histogram, keys=["ref"]), groups))

    return {
        "value_dist_nulls": Check(with_nulls, nulls_sql),
        "value_dist_text": _values("documents", sql.default_modes("documents")),
        "value_dist_text_100": _values(
            "documents", sql.default_modes("documents"), value_chars=VALUE_CHARS
        ),
        "value_dist_prefix6": _values("lineitem", {"l_shipdate": "A", "l_partkey": "A"}),
        "value_dist_yyyymm": Check(months, month_sql),
        "value_dist_range": Check(lambda f: range_columns(f, False), range_sql(False)),
        "value_dist_range_rounded": Check(lambda f: range_columns(f, True), range_sql(True)),
        "value_dist_b_fallback": _values("part", {"p_type": "B", "p_name": "B"}),
        "value_dist_single": _values("orders", _ORDER_MODES, strategy="per_column"),
        "value_dist_multi_orders": _values("orders", _ORDER_MODES),
        "value_dist_multi_lineitem": _values("lineitem", _LINE_MODES),
        "value_dist_multi_events": _values("events", _EVENT_MODES),
        "value_dist_joint_preagg": _values("lineitem", _LINE_MODES, strategy="joint"),
        "value_dist_all": Check(lambda f: _short(every(f)), all_values),
        "sample_top3": Check(samples, sql.samples(all_values)),
    }


def _pattern_checks() -> dict[str, Check]:
    def transformed(mode: str) -> Check:
        """Every text value of customers and pages next to its pattern, counted."""

        def build(frames: Frames) -> DataFrame:
            texts = (
                frames["customer"].select(F.col("c_name").alias("txt"))
                .unionByName(frames["pages"].select(F.col("url").alias("txt")))
                .unionByName(frames["documents"].select(F.col("text").alias("txt")))
                .unionByName(
                    frames["customer"].select(
                        F.concat(F.lit("홍길동-"), "c_mktsegment", F.lit(" #*N é😀")).alias("txt")
                    )
                )
            )
            return texts.groupBy(char_pattern(F.col("txt"), mode).alias("col_pat")).agg(
                F.count(F.lit(1)).alias("n")
            )

        return Check(
            build,
            f"""SELECT {sql.pattern('txt', mode)} AS col_pat, count(*) AS n FROM (
    SELECT c_name AS txt FROM customer UNION ALL SELECT url FROM pages
    UNION ALL SELECT text FROM documents
    UNION ALL SELECT '홍길동-' || c_mktsegment || ' #*N é😀' FROM customer) GROUP BY 1""",
        )

    order_values = sql.values("orders", _ORDER_MODES, chars=None)
    event_values = sql.values("events", _EVENT_MODES, chars=None)
    text_values = sql.union(sql.values(t, chars=None) for t in _TEXT_TABLES)

    def two_histograms(frames: Frames) -> DataFrame:
        return value_histogram(
            [
                profile_input(frames["orders"], "orders", _ORDER_MODES),
                profile_input(frames["events"], "events", _EVENT_MODES),
            ],
            value_chars=None,
        )

    def from_all_values(frames: Frames) -> DataFrame:
        return patterns_from_values(value_histogram(inputs(frames, *_TEXT_TABLES), value_chars=None))

    def direct_all(frames: Frames) -> DataFrame:
        return patterns_direct(inputs(frames, *_TEXT_TABLES), value_chars=None)

    direct_sql = sql.union(sql.patterns(t, chars=None) for t in _TEXT_TABLES)
    values_sql = sql.patterns_of(sql.union((order_values, event_values)))
    return {
        "pattern_transform": transformed("executed"),
        "pattern_transform_documented": transformed("documented"),
        "pattern_from_values": Check(
            lambda f: _short(pattern_counts_from_values(two_histograms(f))), values_sql
        ),
        "pattern_share": Check(
            lambda f: _short(patterns_from_values(two_histograms(f))), sql.shared(values_sql)
        ),
        "pattern_top1": Check(
            lambda f: _short(
                top_pattern(pattern_counts_direct(inputs(f, *_TEXT_TABLES), value_chars=None))
            ),
            sql.top_pattern(direct_sql),
        ),
        "pattern_direct_customer": _patterns("customer"),
        "pattern_direct_part": _patterns("part"),
        "pattern_direct_documents": _patterns("documents"),
        "pattern_direct_documents_100": _patterns("documents", VALUE_CHARS),
        "pattern_direct_pages": _patterns("pages"),
        "pattern_direct_events": _patterns("events"),
        "pattern_two_phase": _patterns("events", two_phase=True),
        "pattern_direct_all": Check(lambda f: _short(direct_all(f)), sql.shared(direct_sql)),
        "pattern_from_values_all": Check(
            lambda f: _short(from_all_values(f)), sql.shared(sql.patterns_of(text_values))
        ),
    }


def _old_master(frames: Frames) -> DataFrame:
    """A column master of the given tables that holds results of an earlier run."""
    columns = lake.columns(frames.spark, frames).withColumns(
        {"chasu": F.lit(1), "db_nm": F.lit("lake")}
    )
    none = lake.empty(frames.spark, "constraints")
    snapshot = Snapshot(
        lake.empty(frames.spark, "tables"), columns, lake.empty(frames.spark, "segments"),
        none, lake.empty(frames.spark, "constraint_columns"), lake.empty(frames.spark, "indexes"),
    )
    return column_population(snapshot, RUN_TS).withColumns(
        {
            "notnull_cnt": F.lit(-1).cast("bigint"),
            "col_kind": F.lit(-1).cast("bigint"),
            "max_col_val": F.lit("old"),
            "min_col_val": F.lit("old"),
            "max_len": F.lit(-1),
            "sample_data": F.lit("old"),
            "top_col_pat": F.lit("old"),
        }
    )


def _written_back(facts, columns) -> object:
    def build(frames: Frames) -> DataFrame:
        updated = update_by_key(_old_master(frames), facts(frames), COLUMN_KEY, columns)
        return updated.select("tab_nm", "col_nm", *columns)

    return build


def _writeback_sql(facts: str, old: Mapping[str, str]) -> str:
    picked = ", ".join(f"if(f.col_nm IS NULL, {v}, f.{c}) AS {c}" for c, v in old.items())
    return f"""SELECT c.tab_nm, c.col_nm, {picked}
FROM {sql.column_list(TABLES)} LEFT JOIN ({facts}) f USING (tab_nm, col_nm)"""


def _writeback_checks() -> dict[str, Check]:
    stats_old = {
        "notnull_cnt": "-1", "col_kind": "-1", "max_col_val": "'old'", "min_col_val": "'old'",
        "max_len": "-1",
    }
    all_values = sql.union(sql.values(t, chars=None) for t in _TEXT_TABLES)
    all_patterns = sql.union(sql.patterns(t, chars=None) for t in _TEXT_TABLES)

    def histogram(frames: Frames) -> DataFrame:
        return value_histogram(inputs(frames, *_TEXT_TABLES), value_chars=None)

    def patterns(frames: Frames) -> DataFrame:
        return top_pattern(
            pattern_counts_direct(inputs(frames, *_TEXT_TABLES), value_chars=None)
        )

    return {
        "writeback_column_stats": Check(
            _written_back(lambda f: column_stats(inputs(f, *TABLES)), STAT_COLUMNS),
            _writeback_sql(sql.union(map(sql.stats, TABLES)), stats_old),
        ),
        "writeback_sample_data": Check(
            _written_back(lambda f: sample_values(histogram(f)), ["sample_data"]),
            _writeback_sql(sql.samples(all_values), {"sample_data": "'old'"}),
        ),
        "writeback_top_pattern": Check(
            _written_back(patterns, ["top_col_pat"]),
            _writeback_sql(sql.top_pattern(all_patterns), {"top_col_pat": "'old'"}),
        ),
    }


def report(frames: Frames) -> DataFrame:
    """Full profile of every given table, a row per column."""
    return _short(profile_report(inputs(frames, *TABLES), value_chars=None))


def _report_sql() -> str:
    stats = sql.union(map(sql.stats, TABLES))
    counts = sql.union(f"SELECT '{t}' AS tab_nm, count(*) AS tab_cnt FROM {t}" for t in TABLES)
    values = sql.union(sql.values(t, chars=None) for t in _TEXT_TABLES)
    return f"""
WITH vals AS ({values}), pats AS ({sql.patterns_of('SELECT * FROM vals')})
SELECT s.*, tab_cnt, sample_data, top_col_pat
FROM ({stats}) s JOIN ({counts}) USING (tab_nm)
LEFT JOIN ({sql.samples('SELECT * FROM vals')}) USING (tab_nm, col_nm)
LEFT JOIN ({sql.top_pattern('SELECT * FROM pats')}) USING (tab_nm, col_nm)"""


def _full_run(frames: Frames) -> DataFrame:
    """Dictionary, registration and all levels through a store; the column master."""
    spark = frames.spark
    store = scratch_store(frames)
    sources = SourceRegistry(spark)
    sources.register_files("lake", frames.root)
    files = lake.segments(spark, frames.root)
    parts = {
        "tables": lake.tables(files),
        "columns": lake.columns(spark, frames),
        "segments": files,
        **{k: lake.empty(spark, k) for k in ("constraints", "constraint_columns", "indexes")},
    }
    collect_dictionary(spark, store, "lake", parts, RUN_TS)
    register_population(store, "lake", ["main"], RUN_TS)
    profiler = Profiler(
        store, lambda _owner, tab: sources.table("lake", tab), "lake", decimals=DECIMALS,
        value_chars=None, clock=lambda: RUN_TS,
    )
    profiler.run()
    tables = store.master("table_master").select("tab_nm", "tab_cnt")
    return (
        store.master("column_master")
        .join(tables, "tab_nm")
        .select("tab_nm", "col_nm", *STAT_COLUMNS, "tab_cnt", "sample_data", "top_col_pat")
    )


def _run_checks() -> dict[str, Check]:
    adhoc = """SELECT o_orderpriority, count(*) AS n, max(o_custkey) AS top_customer
FROM {orders} WHERE o_orderstatus <> {status} GROUP BY o_orderpriority"""
    full_run_sql = f"""
SELECT c.tab_nm, c.col_nm, r.* EXCLUDE (tab_nm, col_nm, tab_cnt), n.tab_cnt
FROM {sql.column_list(TABLES)} LEFT JOIN ({_report_sql()}) r USING (tab_nm, col_nm)
JOIN ({sql.union(f"SELECT '{t}' AS tab_nm, count(*) AS tab_cnt FROM {t}" for t in TABLES)}) n
USING (tab_nm)"""
    return {
        "source_adhoc_query": Check(
            lambda frames: adhoc_query(
                frames.spark,
                adhoc.replace("{status}", ":status"),
                {"orders": frames["orders"]},
                {"status": "P"},
            ),
            adhoc.replace("{orders}", "orders").replace("{status}", "'P'"),
        ),
        "profile_report": Check(report, _report_sql()),
        "profile_full_run": Check(_full_run, full_run_sql),
    }


def _remote_checks() -> dict[str, Check]:
    """Tables grouped by SELECTs, some of them beside tables read from files."""
    there = ("nation", "customer", "orders", "documents")
    here = ("part", "events")
    every = (*there, *here)

    def mixed(frames: Frames, modes: Mapping[str, Mapping[str, str]] | None = None):
        own = modes or {}
        far = [remote_input(frames, t, own.get(t)) for t in there if not modes or t in own]
        return far + [profile_input(frames[t], t, own.get(t)) for t in here if not modes or t in own]

    modes = {
        "orders": _ORDER_MODES, "customer": {"c_acctbal": "B", "c_mktsegment": "Y", "c_name": "A"},
        "events": _EVENT_MODES,
    }
    return {
        "remote_row_counts": Check(
            lambda f: _short(remote.counts(mixed(f))),
            sql.union(f"SELECT '{t}' AS tab_nm, count(*) AS tab_cnt FROM {t}" for t in every),
        ),
        "remote_column_stats": Check(
            lambda f: _short(remote.stats(mixed(f))), sql.union(map(sql.stats, every))
        ),
        "remote_value_dist": Check(
            lambda f: _short(remote.histogram(mixed(f, modes))),
            sql.union(sql.values(t, m) for t, m in modes.items()),
        ),
        "remote_value_dist_batches": Check(
            lambda f: _short(
                remote.histogram([remote_input(f, "lineitem", _LINE_MODES)], batch_columns=2)
            ),
            sql.values("lineitem", _LINE_MODES),
        ),
    }


#: A third of the orders each, by key; the third batch replaces the first.
_BATCHES = ("o_orderkey % 3 = 0", "o_orderkey % 3 = 1", "o_orderkey % 2 = 0")


def _loads(frames: Frames) -> tuple[LakeTable, list]:
    """A lake table of orders, and what puts its three batches there."""
    root = f"{shared_dir(frames.spark)}/orders-{uuid.uuid4().hex}"
    schema = frames["orders"].schema.simpleString()[len("struct<") : -1]
    schema = ", ".join(part.replace(":", " ", 1) for part in schema.split(","))

    def put(batch: int, folder: str) -> None:
        rows = frames["orders"].where(_BATCHES[batch])
        rows.write.mode("overwrite").parquet(f"{root}/{folder}")

    steps = [lambda: put(0, "a"), lambda: put(1, "b"), lambda: put(2, "a")]
    return LakeTable(frames.spark, root, schema), steps


def _incremental(frames: Frames, kind: incremental.Kind) -> tuple[DataFrame, ProfileInput]:
    """The merged partials after each batch was loaded and read once, and the table."""
    store = scratch_store(frames)
    spec = profile_input(frames["orders"], "orders", _ORDER_MODES).spec
    table, steps = _loads(frames)
    for put in steps:
        put()
        incremental.refresh(store, kind, spec, table)
    return incremental.current(store, kind, spec), ProfileInput(spec, table.frame())


def _compared(sketches: DataFrame, sources: list[ProfileInput]) -> DataFrame:
    """Exact distinct counts, and whether the estimates are inside their bound."""
    exact = distinct_counts(sources).withColumnRenamed("col_kind", "exact")
    inside = F.col("exact").between(F.col("least_kind"), F.col("most_kind"))
    found = estimates(sketches).join(exact, list(COLUMN_KEY))
    return found.select("tab_nm", "col_nm", F.col("exact").alias("col_kind"), inside.alias("inside"))


def _estimated(frames: Frames) -> DataFrame:
    """Sketches of two halves of every table, united."""
    halves = [
        [
            ProfileInput(s.spec, s.frame.where(F.pmod(F.xxhash64(s.frame.columns[0]), F.lit(2)) == i))
            for s in inputs(frames, *TABLES)
        ]
        for i in (0, 1)
    ]
    sketches = union_sketches(
        distinct_sketches(halves[0]).unionByName(distinct_sketches(halves[1]))
    )
    return _compared(sketches, inputs(frames, *TABLES))


def _text_lake(frames: Frames) -> DataFrame:
    """Statistics of tables that were written as CSV and JSON and are read back by name."""
    root = f"{shared_dir(frames.spark)}/text-{uuid.uuid4().hex}"
    formats = {"customer": "csv", "part": "json", "nation": "csv"}
    sources = SourceRegistry(frames.spark)
    for fmt in ("csv", "json"):
        sources.register_files(fmt, f"{root}/{fmt}", fmt, schemas={t: frames[t].schema for t in formats})
    for table, fmt in formats.items():
        frames[table].write.format(fmt).save(f"{root}/{fmt}/{table}.{fmt}")
    return _short(
        column_stats([profile_input(sources.table(fmt, t), t) for t, fmt in formats.items()])
    )


def _packing_population(frames: Frames) -> DataFrame:
    """Suppliers as owners and their parts' first digits as tables, sized by what they sold."""
    return frames["lineitem"].groupBy(
        F.col("l_suppkey").cast("string").alias("owner_nm"),
        F.substring(F.col("l_partkey").cast("string"), 1, 1).alias("tab_nm"),
    ).agg(F.sum("l_quantity").cast("bigint").alias("tab_size"))


_PACKING_SQL = """
WITH t AS (
  SELECT l_suppkey::VARCHAR AS owner_nm, left(l_partkey::VARCHAR, 1) AS tab_nm,
    sum(l_quantity)::BIGINT AS tab_size
  FROM lineitem GROUP BY 1, 2
),
placed AS (
  SELECT *, row_number() OVER largest AS nr,
    coalesce(sum(CASE WHEN tab_size < 3000 THEN tab_size END) OVER before, 0) AS mb,
    coalesce(sum(CASE WHEN tab_size < 3000 THEN 1 END) OVER before, 0) AS tables
  FROM t WINDOW largest AS (ORDER BY tab_size DESC, owner_nm, tab_nm),
    before AS (ORDER BY tab_size DESC, owner_nm, tab_nm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
slots AS (
  SELECT *, CASE WHEN tab_size >= 3000 THEN nr::VARCHAR
      ELSE 's' || floor(mb / 3000)::BIGINT || '/' || floor(tables / 40)::BIGINT END AS slot
  FROM placed
),
jobs AS (SELECT slot, row_number() OVER (ORDER BY min(nr)) AS job_no FROM slots GROUP BY slot)
SELECT owner_nm, tab_nm, tab_size, job_no::INTEGER AS job_no FROM slots JOIN jobs USING (slot)"""


def _growth_checks() -> dict[str, Check]:
    loaded = f"(SELECT * FROM orders WHERE {_BATCHES[2]} UNION ALL SELECT * FROM orders WHERE {_BATCHES[1]})"
    counted = sql.union(
        f"SELECT tab_nm, col_nm, col_kind, true AS inside FROM ({sql.stats(t)}) WHERE col_kind > 0"
        for t in TABLES
    )

    def sketched(frames: Frames) -> DataFrame:
        made, source = _incremental(frames, incremental.SKETCH)
        return _compared(made, [source])

    return {
        "value_dist_incremental": Check(
            lambda f: _short(_incremental(f, incremental.HISTOGRAM)[0]),
            sql.values("orders", _ORDER_MODES).replace("FROM orders", f"FROM {loaded}"),
        ),
        "distinct_sketch_incremental": Check(
            sketched,
            "SELECT tab_nm, col_nm, col_kind, true AS inside FROM "
            f"({sql.stats('orders').replace('FROM orders', f'FROM {loaded}')})",
        ),
        "distinct_sketch_bounds": Check(_estimated, counted),
        "sample_top3_bounded": Check(
            lambda f: _short(sample_values_bounded(inputs(f, *_TEXT_TABLES))),
            sql.samples(sql.union(sql.values(t, chars=None) for t in _TEXT_TABLES)),
        ),
        "pattern_top1_bounded": Check(
            lambda f: _short(top_pattern_bounded(inputs(f, *_TEXT_TABLES))),
            sql.top_pattern(sql.union(sql.patterns(t, chars=None) for t in _TEXT_TABLES)),
        ),
        "column_stats_text_lake": Check(_text_lake, sql.union(map(sql.stats, ("customer", "part", "nation")))),
        "plan_job_packing": Check(
            lambda f: packed(_packing_population(f), job_mb=3000, most_tables=40), _PACKING_SQL
        ),
    }


def checks() -> dict[str, Check]:
    return (
        _column_checks()
        | _growth_checks()
        | _remote_checks()
        | _value_checks()
        | _pattern_checks()
        | _writeback_checks()
        | _run_checks()
    )
