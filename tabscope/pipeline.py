"""The whole run: dictionary, registration, and the four profile levels."""

from __future__ import annotations

import datetime as dt
import logging
import threading
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import contextmanager
from itertools import groupby, islice

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.operators import incremental, registration, remote
from tabscope.operators.dictionary.common import stamped
from tabscope.operators.dictionary.snapshot import next_snapshot, require_snapshot, snapshot_row
from tabscope.operators.merge import update_by_key
from tabscope.operators.pattern_dist import patterns_direct, patterns_from_values, top_pattern
from tabscope.operators.remote import RemoteInput, RemoteTable
from tabscope.operators.value_dist import sample_values
from tabscope.plans import packing
from tabscope.plans.spec import (
    COLUMN_KEY,
    DEFAULT_PROFILE,
    TABLE_KEY,
    ProfileInput,
    TableSpec,
    specs_from_masters,
)
from tabscope.sources.lake_files import LakeTable
from tabscope.sources.ledger import Ledger, plan_id, table_id
from tabscope.sources.store import VALUE_SCOPE, ResultStore

LEVELS = ("table", "column", "value", "pattern")
STAT_COLUMNS = ("notnull_cnt", "col_kind", "max_col_val", "min_col_val", "max_len")

#: Tables profiled by one Spark job. Keeps the plan of a large estate bounded.
TABLES_PER_JOB = 50

#: A level that failed longer ago starts over: its tables may have changed.
RESUME_WITHIN = dt.timedelta(hours=24)

#: Row counts that run side by side. Each is a job of its own, for a time window of its own.
COUNTS_AT_ONCE = 8

#: Dictionary parts loaded side by side: one fills the cores that another's last tasks leave.
LOADS_AT_ONCE = 3

log = logging.getLogger(__name__)

Clock = Callable[[], dt.datetime]


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def collect_dictionary(
    spark: SparkSession,
    store: ResultStore,
    db_nm: str,
    parts: Mapping[str, DataFrame],
    run_ts: dt.datetime,
    chasu: int | None = None,
) -> int:
    """Write one dictionary snapshot and return its number.

    ``parts`` maps the dictionary kinds to normalised frames. Without a number the next
    free one is taken. Collecting a number again replaces it, also by nothing.
    """
    if chasu is None:
        chasu = next_snapshot(store.read("dic_snapshots"), db_nm).first()["chasu"]
    scope = {"db_nm": db_nm, "chasu": chasu}

    def load(kind: str) -> None:
        rows = stamped(parts[kind], db_nm, chasu, run_ts.date())
        store.replace_scope(f"dic_{kind}", rows, scope)

    with ThreadPoolExecutor(LOADS_AT_ONCE) as pool:
        list(pool.map(inheritable_thread_target(spark)(load), parts))
    # The row that makes this snapshot the latest comes last: it is never incomplete.
    store.replace_scope("dic_snapshots", snapshot_row(spark, db_nm, chasu, run_ts), scope)
    return chasu


def stored_snapshot(store: ResultStore) -> registration.Snapshot:
    return registration.Snapshot(
        **{
            kind: store.read(f"dic_{kind}")
            for kind in registration.Snapshot.__dataclass_fields__
        }
    )


def register_population(
    store: ResultStore,
    db_nm: str,
    schemas: Sequence[str],
    run_ts: dt.datetime,
    prfl_id: str = DEFAULT_PROFILE,
    per_profile: bool = True,
) -> int:
    """Register the latest snapshot of a database; returns the snapshot number."""
    chasu = require_snapshot(store.read("dic_snapshots"), db_nm)
    tables, columns = registration.register(
        stored_snapshot(store).of(db_nm, chasu, schemas),
        store.master("table_master"),
        store.master("column_master"),
        db_nm,
        run_ts,
        prfl_id,
        per_profile,
    )
    store.write_master("table_master", tables)
    store.write_master("column_master", columns)
    return chasu


class Profiler:
    """Runs the profile levels of one database and writes the result tables.

    The population is read and its tables are opened job by job, so neither the driver nor
    a plan grows with the estate. What the jobs of a level find is staged and merged into
    the master once. A level that fails keeps what its finished jobs have found: run again
    within ``resume_within``, it opens only the tables that are left (None: always starts
    over). With ``job_mb`` tables are packed into jobs by size instead of by name, and
    ``jobs_at_once`` of them run side by side in the scheduler pool of their parallelism
    tier (see :mod:`tabscope.plans.packing`). ``read_table`` gives a DataFrame, or a :class:`RemoteTable` whose source then
    counts and groups by itself. ``value_chars`` is the width of histogram values and patterns,
    ``extreme_chars`` that of extremes; None keeps whole texts.
    """

    def __init__(
        self,
        store: ResultStore,
        read_table: Callable[[str, str], DataFrame | RemoteTable],
        db_nm: str,
        prfl_id: str = DEFAULT_PROFILE,
        decimals: int | None = None,
        value_chars: int | None = None,
        extreme_chars: int | None = None,
        tables_per_job: int = TABLES_PER_JOB,
        job_mb: int | None = None,
        jobs_at_once: int = 1,
        counts_at_once: int = COUNTS_AT_ONCE,
        clock: Clock = _now,
        resume_within: dt.timedelta | None = RESUME_WITHIN,
    ):
        self._store = store
        self._read = read_table
        self._db_nm = db_nm
        self._prfl_id = prfl_id
        self._decimals = decimals
        self._value_chars = value_chars
        self._extreme_chars = extreme_chars
        self._per_job = tables_per_job
        self._job_mb = job_mb
        self._jobs_at_once = jobs_at_once
        self._at_once = counts_at_once
        self._clock = clock
        self._clock_lock = threading.Lock()
        self._resume_within = resume_within

    def specs(self) -> Iterator[TableSpec]:
        return specs_from_masters(
            self._store.master("table_master"),
            self._store.master("column_master"),
            self._db_nm,
            self._prfl_id,
            self._decimals,
            None if self._job_mb is None else self._packed,
        )

    def _packed(self, tables: DataFrame) -> DataFrame:
        return packing.packed(tables, self._job_mb, self._per_job)

    def _opened(self, spec: TableSpec) -> ProfileInput:
        table = self._read(spec.owner_nm, spec.tab_nm)
        if isinstance(table, RemoteTable):
            return RemoteInput(spec, table)
        source = ProfileInput(spec, table)
        if missing := source.missing_columns():
            log.warning(
                "%s.%s no longer has the registered columns %s",
                spec.owner_nm, spec.tab_nm, ", ".join(missing),
            )
        return source

    def inputs(self) -> Iterator[ProfileInput]:
        """The population, each table opened when it is reached."""
        return map(self._opened, self.specs())

    def _jobs(
        self,
        inputs: Iterable[ProfileInput] | None,
        wanted: Callable[[ProfileInput], object] = lambda source: True,
        done: Callable[[TableSpec], bool] = lambda spec: False,
    ) -> Iterator[list[ProfileInput]]:
        """The wanted tables, some at a time; those that are ``done`` are not opened."""
        if inputs is None:
            left = (self._opened(spec) for spec in self.specs() if not done(spec))
        else:
            left = (source for source in inputs if not done(source.spec))
        for _, tables in groupby(filter(wanted, left), lambda source: source.spec.job_no):
            while job := list(islice(tables, self._per_job)):
                yield job

    def _each(
        self,
        jobs: Iterable[tuple[list[ProfileInput], dict[str, str]]],
        work: Callable[[list[ProfileInput], dict[str, str]], None],
    ) -> None:
        """Do all jobs, ``jobs_at_once`` side by side, each in the pool of its tier.

        A job that fails lets those that run beside it end first: they are noted.
        """
        spark = self._store.spark

        def one(job: list[ProfileInput], tables: dict[str, str]) -> None:
            with packing.in_pool(spark, max((s.spec.exec_dop or 0 for s in job), default=0)):
                work(job, tables)

        if self._jobs_at_once == 1:
            for job, tables in jobs:
                one(job, tables)
            return
        with ThreadPoolExecutor(self._jobs_at_once) as pool:
            running: set[Future] = set()
            for job, tables in jobs:
                running.add(pool.submit(one, job, tables))
                if len(running) >= self._jobs_at_once:
                    ended, running = wait(running, return_when=FIRST_COMPLETED)
                    for future in ended:
                        future.result()
            for future in running:
                future.result()

    @contextmanager
    def _level(
        self,
        name: str,
        inputs: Iterable[ProfileInput] | None,
        wanted: Callable[[ProfileInput], object] = lambda source: True,
        options: Mapping[str, object] | None = None,
    ) -> Iterator[tuple[Ledger, Iterator[tuple[list[ProfileInput], dict[str, str]]]]]:
        """The ledger of a level, and the jobs it does not hold yet with what to note."""
        how = (name, sorted((options or {}).items()))
        max_age = self._resume_within or dt.timedelta(0)
        level = f"{self._db_nm}/{self._prfl_id}/{how!r}"
        now = self._clock()
        with self._store.resumable(level, now, max_age) as ledger:
            if self._resume_within is None and ledger:
                ledger.discard()
            if ledger:
                log.warning("taking up the %s level where it failed", name)

            def plan(spec: TableSpec) -> str:
                return plan_id(spec, how)

            def done(spec: TableSpec) -> bool:
                return ledger.finished(table_id(spec), plan(spec))

            jobs = (
                (job, {table_id(source.spec): plan(source.spec) for source in job})
                for job in self._jobs(inputs, wanted, done)
            )
            yield ledger, jobs

    def _update_columns(self, facts: DataFrame, columns: Sequence[str]) -> None:
        stamp = F.lit(self._clock()).cast("timestamp_ntz")
        self._store.update_master(
            "column_master",
            lambda master: update_by_key(master, facts, COLUMN_KEY, columns, stamp),
        )

    def _counted(self, source: ProfileInput) -> tuple:
        """Row count of one table, with the time it began and ended."""
        with self._clock_lock:
            started = self._clock()
        row = remote.counts([source]).first()
        with self._clock_lock:
            return (*(row[c] for c in (*TABLE_KEY, "tab_cnt")), started, self._clock())

    def run_table_level(self, inputs: Iterable[ProfileInput] | None = None) -> None:
        """Row counts, each with its own wall-clock window; several tables at once."""
        types = "db_nm string, owner_nm string, tab_nm string, prfl_id string, tab_cnt bigint"
        window = ["tabcnt_str_dt", "tabcnt_end_dt"]
        fields = ", ".join([types, *[f"{w} timestamp_ntz" for w in window]])
        spark = self._store.spark
        with (
            self._level("table", inputs) as (ledger, jobs),
            ThreadPoolExecutor(self._at_once) as pool,
        ):
            for job, tables in jobs:
                # One row per table of the job: bounded by ``tables_per_job``.
                counted = spark.createDataFrame(list(pool.map(self._counted, job)), fields)
                ledger.add(counted, tables)
            if ledger:
                stamp = F.lit(self._clock()).cast("timestamp_ntz")
                self._store.update_master(
                    "table_master",
                    lambda master: update_by_key(
                        master, ledger.rows(), TABLE_KEY, ["tab_cnt", *window], stamp
                    ),
                )

    def run_column_level(self, inputs: Iterable[ProfileInput] | None = None) -> None:
        options = {"extreme_chars": self._extreme_chars}
        with self._level("column", inputs, ProfileInput.stat_columns, options) as (ledger, jobs):
            self._each(jobs, lambda job, tables: ledger.add(remote.stats(job, **options), tables))
            if ledger:
                self._update_columns(ledger.rows(), STAT_COLUMNS)

    def run_value_level(
        self, inputs: Iterable[ProfileInput] | None = None, **options
    ) -> None:
        """Replace the histogram of every flagged table, then refresh the samples.

        Histograms are written first and the samples read the written table, so the
        source is scanned once.
        """
        options = {"value_chars": self._value_chars, **options}
        with self._level("value", inputs, ProfileInput.value_columns, options) as (ledger, jobs):

            def replaced(job: list[ProfileInput], tables: dict[str, str]) -> None:
                self._store.replace_scopes(
                    "column_values",
                    remote.histogram(job, **options),
                    [{c: getattr(source.spec, c) for c in VALUE_SCOPE} for source in job],
                )
                ledger.add(None, tables)

            self._each(jobs, replaced)
            if ledger:
                self._update_columns(sample_values(self.values()), ["sample_data"])

    def refresh_values(
        self, lake_table: Callable[[str, str], LakeTable], **options
    ) -> dict[tuple[str, str], int]:
        """The value level of lake tables from their new files only, samples included.

        Partial histograms of files are kept (see :mod:`tabscope.operators.incremental`);
        a table without new, changed or removed files is not touched. Returns the number
        of files read of every table. Keep the options the same from refresh to refresh.
        """
        options = {"value_chars": self._value_chars, **options}
        read: dict[tuple[str, str], int] = {}
        for spec in self.specs():
            if not any(c.use and c.value_mode in ("Y", "A", "B") for c in spec.columns):
                continue
            table = lake_table(spec.owner_nm, spec.tab_nm)
            before = self._store.view(incremental.HISTOGRAM.files).number
            count = incremental.refresh(
                self._store, incremental.HISTOGRAM, spec, table, **options
            )
            read[spec.owner_nm, spec.tab_nm] = count
            if self._store.view(incremental.HISTOGRAM.files).number > before:
                self._store.replace_scopes(
                    "column_values",
                    incremental.current(self._store, incremental.HISTOGRAM, spec),
                    [{c: getattr(spec, c) for c in VALUE_SCOPE}],
                )
        if read:
            self._update_columns(sample_values(self.values()), ["sample_data"])
        return read

    def run_pattern_level(
        self,
        source: str = "values",
        mode: str = "executed",
        inputs: Iterable[ProfileInput] | None = None,
        **options,
    ) -> None:
        """Replace all patterns of the profile, from the value histograms or the tables."""
        scope = {"db_nm": self._db_nm, "prfl_id": self._prfl_id}
        if source == "values":
            columns = self._store.master("column_master").filter(
                (F.col("db_nm") == self._db_nm) & (F.col("prfl_id") == self._prfl_id)
            )
            patterns = patterns_from_values(self.values(), mode, columns.count())
            self._store.replace_scope("column_patterns", patterns, scope)
        elif source == "direct":
            options = {"mode": mode, "value_chars": self._value_chars, **options}
            level = self._level("pattern", inputs, ProfileInput.pattern_columns, options)
            with level as (ledger, jobs):
                self._each(
                    jobs, lambda job, tables: ledger.add(patterns_direct(job, **options), tables)
                )
                if not ledger:
                    return
                self._store.replace_scope("column_patterns", ledger.rows(), scope)
        else:
            raise ValueError(f"unknown pattern source {source!r}; expected values or direct")
        self._update_columns(top_pattern(self.patterns()), ["top_col_pat"])

    def run(
        self, levels: Sequence[str] = LEVELS, pattern_source: str = "values"
    ) -> None:
        """All requested levels in order."""
        unknown = set(levels) - set(LEVELS)
        if unknown:
            raise ValueError(f"unknown levels {sorted(unknown)}; expected some of {LEVELS}")
        steps = {
            "table": self.run_table_level,
            "column": self.run_column_level,
            "value": self.run_value_level,
            "pattern": lambda: self.run_pattern_level(pattern_source),
        }
        for level in LEVELS:
            if level in levels:
                steps[level]()

    def _of_profile(self, table: str) -> DataFrame:
        return self._store.read(table, {"db_nm": self._db_nm, "prfl_id": self._prfl_id})

    def values(self) -> DataFrame:
        return self._of_profile("column_values")

    def patterns(self) -> DataFrame:
        return self._of_profile("column_patterns")
