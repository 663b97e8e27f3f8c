"""Profiling plan: which tables and columns, and how each column is bucketed.

The plan is plain data. It is the only thing that ever lives on the driver; its
size is that of the catalog, not of the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.types import is_character, is_unstructured

#: Identity of a profiled column in every result table.
COLUMN_KEY = ("db_nm", "owner_nm", "tab_nm", "col_nm", "prfl_id")
TABLE_KEY = ("db_nm", "owner_nm", "tab_nm", "prfl_id")
DEFAULT_PROFILE = "P01"


@dataclass(frozen=True)
class ColumnSpec:
    col_nm: str
    value_mode: str | None = None
    pattern: bool = False
    use: bool = True
    vendor_type: str | None = None
    decimals: int | None = None


@dataclass(frozen=True)
class TableSpec:
    db_nm: str
    owner_nm: str
    tab_nm: str
    columns: tuple[ColumnSpec, ...] = ()
    prfl_id: str = DEFAULT_PROFILE
    use: bool = True
    #: Where the table is worked on; no part of how.
    job_no: int | None = field(default=None, repr=False, compare=False)
    exec_dop: int | None = field(default=None, repr=False, compare=False)

    def with_modes(self, **modes: str | None) -> "TableSpec":
        """Same table with the value mode of the named columns replaced."""
        columns = tuple(
            replace(c, value_mode=modes[c.col_nm]) if c.col_nm in modes else c
            for c in self.columns
        )
        return replace(self, columns=columns)


@dataclass(frozen=True)
class ProfileInput:
    """A table to profile together with the DataFrame that reads it."""

    spec: TableSpec
    frame: DataFrame = field(compare=False)

    def dtype(self, col_nm: str) -> T.DataType:
        return self.frame.schema[col_nm].dataType

    def missing_columns(self) -> list[str]:
        """Registered columns the table no longer has."""
        held = set(self.frame.columns)
        return [c.col_nm for c in self.spec.columns if c.use and c.col_nm not in held]

    def _structured(self) -> list[ColumnSpec]:
        held = set(self.frame.columns)
        return [
            c
            for c in self.spec.columns
            if c.use
            and c.col_nm in held
            and not is_unstructured(self.dtype(c.col_nm), c.vendor_type)
        ]

    def stat_columns(self) -> list[ColumnSpec]:
        return self._structured()

    def value_columns(self) -> list[ColumnSpec]:
        return [c for c in self._structured() if c.value_mode in ("Y", "A", "B")]

    def pattern_columns(self) -> list[ColumnSpec]:
        return [c for c in self._structured() if c.pattern]


def spec_from_schema(
    frame: DataFrame,
    tab_nm: str,
    *,
    db_nm: str = "lake",
    owner_nm: str = "main",
    prfl_id: str = DEFAULT_PROFILE,
    decimals: int | None = None,
    modes: Mapping[str, str | None] | None = None,
) -> TableSpec:
    """Default plan of a table: text columns get value mode Y and patterns."""
    modes = modes or {}
    columns = tuple(
        ColumnSpec(
            f.name,
            value_mode=modes.get(f.name, "Y" if is_character(f.dataType) else None),
            pattern=is_character(f.dataType),
            decimals=decimals if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else None,
        )
        for f in frame.schema.fields
    )
    return TableSpec(db_nm, owner_nm, tab_nm, columns, prfl_id)


def profile_targets(table_master: DataFrame, db_nm: str, prfl_id: str) -> DataFrame:
    """Tables of one profile that are switched on, in owner and table order."""
    return (
        _wanted(table_master, db_nm, prfl_id)
        .select("owner_nm", "tab_nm")
        .orderBy("owner_nm", "tab_nm")
    )


def _wanted(table_master: DataFrame, db_nm: str, prfl_id: str) -> DataFrame:
    return table_master.filter(
        (F.col("db_nm") == db_nm) & (F.col("prfl_id") == prfl_id) & (F.col("use_yn") == "Y")
    )


def specs_from_masters(
    table_master: DataFrame,
    column_master: DataFrame,
    db_nm: str,
    prfl_id: str = DEFAULT_PROFILE,
    decimals: int | None = None,
    packed: Callable[[DataFrame], DataFrame] | None = None,
) -> Iterator[TableSpec]:
    """The registered population, table by table; the driver holds one table's columns.

    ``packed`` adds a ``job_no`` to (owner_nm, tab_nm, tab_size, exec_dop); tables then
    come job by job.
    """
    key = ["owner_nm", "tab_nm"]
    columns = column_master.filter(
        (F.col("db_nm") == db_nm) & (F.col("prfl_id") == prfl_id)
    ).select(
        *key, "col_nm", "col_seq", "use_yn", "col_data_type", "colval_exec_typ", "colpat_exec_typ"
    )
    if packed is None:
        none = F.lit(None).cast("int")
        targets = profile_targets(table_master, db_nm, prfl_id).withColumns(
            {"job_no": none, "exec_dop": none}
        )
    else:
        targets = packed(_wanted(table_master, db_nm, prfl_id).select(*key, "tab_size", "exec_dop"))
    rows = (
        targets.join(columns, key, "left")
        .orderBy("job_no", *key, "col_seq", "col_nm")
        .toLocalIterator()
    )
    table = itemgetter("job_no", "owner_nm", "tab_nm", "exec_dop")
    for (job_no, owner, tab, dop), members in groupby(rows, table):
        specs = tuple(
            ColumnSpec(
                row["col_nm"],
                value_mode=row["colval_exec_typ"],
                pattern=row["colpat_exec_typ"] == "Y",
                use=row["use_yn"] == "Y",
                vendor_type=row["col_data_type"],
                decimals=decimals,
            )
            for row in members
            if row["col_nm"] is not None
        )
        yield TableSpec(db_nm, owner, tab, specs, prfl_id, job_no=job_no, exec_dop=dop)


@dataclass(frozen=True)
class ColumnRef:
    """A planned column under the short key it carries through a shuffle."""

    ref: str
    source: ProfileInput
    column: ColumnSpec

    @property
    def key(self) -> tuple[str, ...]:
        s = self.source.spec
        return (s.db_nm, s.owner_nm, s.tab_nm, self.column.col_nm, s.prfl_id)


def number_columns(
    picked: Iterable[tuple[ProfileInput, Sequence[ColumnSpec]]],
) -> list[list[ColumnRef]]:
    """Number columns across tables; one list of refs per table with columns."""
    groups, start = [], 0
    for source, columns in picked:
        if columns:
            groups.append(
                [ColumnRef(str(start + i), source, c) for i, c in enumerate(columns)]
            )
            start += len(columns)
    return groups


def name_columns(df: DataFrame, groups: Sequence[Sequence[ColumnRef]]) -> DataFrame:
    """Replace the short key ``ref`` by the identity columns of :data:`COLUMN_KEY`.

    Runs after aggregation: identity strings never travel through the shuffle.
    """
    refs = [r for group in groups for r in group]
    position = F.col("ref").cast("int") + 1
    # Never NULL, and known not to be: joins on the names then need no NULL filters.
    names = [
        F.coalesce(F.element_at(_constant_array([r.key[i] for r in refs]), position), F.lit(""))
        .alias(name)
        for i, name in enumerate(COLUMN_KEY)
    ]
    return df.select(*names, *[c for c in df.columns if c != "ref"])


def _constant_array(values: Sequence[str]) -> Column:
    """An array literal. One split string instead of a call per element."""
    mark = "\x1f"
    if any(mark in v for v in values):
        raise ValueError("a name in the plan holds a unit separator character")
    return F.split(F.lit(mark.join(values)), mark, -1)
