"""SELECTs that have a relational source do the counting and grouping itself.

Each is built from a table's column plan in the source's own dialect and returns a few
rows: row count, column statistics, or value histograms. Text is compared and grouped by
its bytes, whatever the collation of the source, and shown in the source's own text form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from tabscope.functions.buckets import (
    NEGATIVE_LABEL,
    NULL_MARK,
    OTHER_LABEL,
    PREFIX_CHARS,
    RANGES,
    ZERO_LABEL,
)
from tabscope.functions.types import UNSTRUCTURED_NAMES
from tabscope.plans.spec import ColumnSpec

#: Columns per statement: one scan of the source each.
BATCH_COLUMNS = 30

# What a catalog type name holds that means a number, a time, a text.
NUMBERS = ("INT", "FLOAT", "DECIMAL", "NUMERIC", "DOUBLE", "MONEY", "NUMBER", "REAL")
NOT_NUMBERS = ("INTERVAL", "POINT")
FRACTIONS = ("FLOAT", "DOUBLE", "REAL")
TIMES = ("DATE", "TIME")
TEXTS = ("CHAR", "STRING", "TEXT")


def kind_of(vendor_type: str | None) -> str:
    """``number``, ``time``, ``text`` or ``other`` for a catalog type name."""
    name = (vendor_type or "").upper()
    if any(n in name for n in TEXTS):
        return "text"
    if any(n in name for n in NUMBERS) and not any(n in name for n in NOT_NUMBERS):
        return "number"
    return "time" if any(n in name for n in TIMES) else "other"


def is_structured(column: ColumnSpec) -> bool:
    name = (column.vendor_type or "").upper()
    nested = name.startswith(("ARRAY", "MAP", "STRUCT", "BINARY", "VARIANT"))
    return name not in UNSTRUCTURED_NAMES and (not nested or "BINARY_" in name)


@dataclass(frozen=True)
class Dialect:
    """How a vendor writes what the statements need; ``{0}`` is the inner expression."""

    quotes: str
    text: str
    bytes_: str
    length: str
    prefix: str
    decimal: str
    month: str
    rounded: str
    count: str = "COUNT"
    literal: str = "'{0}'"
    grouping_sets: bool = True

    def name(self, *parts: str) -> str:
        first, last = self.quotes
        return ".".join(f"{first}{p.replace(last, last * 2)}{last}" for p in parts)

    def string(self, value: str) -> str:
        return self.literal.format(value.replace("'", "''"))


# The vendors' spelling.
DIALECTS = {
    "oracle": Dialect(
        quotes='""',
        text="TO_CHAR({0})",
        bytes_="{0}",
        length="LENGTH({0})",
        prefix="SUBSTR({0}, 1, {1})",
        decimal="CAST({0} AS NUMBER(38, {1}))",
        month="TO_CHAR({0}, 'YYYYMM')",
        rounded="ROUND({0})",
    ),
    "postgres": Dialect(
        quotes='""',
        text="CAST({0} AS TEXT)",
        bytes_='{0} COLLATE "C"',
        length="CHAR_LENGTH({0})",
        prefix="SUBSTR({0}, 1, {1})",
        decimal="CAST({0} AS NUMERIC(38, {1}))",
        month="TO_CHAR({0}, 'YYYYMM')",
        rounded="ROUND({0})",
    ),
    "mssql": Dialect(
        quotes="[]",
        text="CONVERT(NVARCHAR(MAX), {0})",
        bytes_="{0} COLLATE Latin1_General_BIN2",
        # LEN leaves trailing blanks out.
        length="LEN({0} + N'.') - 1",
        prefix="SUBSTRING({0}, 1, {1})",
        decimal="CAST({0} AS DECIMAL(38, {1}))",
        month="CONVERT(CHAR(6), {0}, 112)",
        rounded="ROUND({0}, 0)",
        count="COUNT_BIG",
        literal="N'{0}'",
    ),
    "mysql": Dialect(
        quotes="``",
        text="CAST({0} AS CHAR CHARACTER SET utf8mb4)",
        bytes_="{0} COLLATE utf8mb4_bin",
        length="CHAR_LENGTH({0})",
        prefix="SUBSTRING({0}, 1, {1})",
        decimal="CAST({0} AS DECIMAL(38, {1}))",
        month="DATE_FORMAT({0}, '%Y%m')",
        rounded="ROUND({0})",
        grouping_sets=False,
    ),
    "spark": Dialect(
        quotes="``",
        text="CAST({0} AS STRING)",
        bytes_="{0}",
        length="CHAR_LENGTH({0})",
        prefix="SUBSTRING({0}, 1, {1})",
        decimal="CAST({0} AS DECIMAL(38, {1}))",
        month="DATE_FORMAT({0}, 'yyyyMM')",
        rounded="ROUND({0})",
    ),
}


def _text(dialect: Dialect, column: ColumnSpec) -> str:
    """A column as text that compares by its bytes."""
    own = dialect.name(column.col_nm)
    name = (column.vendor_type or "").upper()
    if column.decimals is not None and any(f in name for f in FRACTIONS):
        own = dialect.decimal.format(own, column.decimals)
    return dialect.bytes_.format(dialect.text.format(own))


def count_statement(vendor: str, table: Sequence[str]) -> str:
    """One row: ``tab_cnt``."""
    dialect = DIALECTS[vendor]
    return f"SELECT {dialect.count}(*) AS tab_cnt FROM {dialect.name(*table)}"


def stats_statement(vendor: str, table: Sequence[str], columns: Sequence[ColumnSpec]) -> str:
    """One row: for the column with number i ``n{i}`` values, ``k{i}`` distinct ones, the
    highest ``h{i}`` and lowest ``l{i}`` text, and the longest text's length ``m{i}``."""
    dialect = DIALECTS[vendor]
    items = []
    for i, column in enumerate(columns):
        own, text = dialect.name(column.col_nm), _text(dialect, column)
        key = text if kind_of(column.vendor_type) == "text" else own
        items += [
            f"{dialect.count}({own}) AS n{i}",
            f"{dialect.count}(DISTINCT {key}) AS k{i}",
            f"MAX({text}) AS h{i}",
            f"MIN({text}) AS l{i}",
            f"MAX({dialect.length.format(text)}) AS m{i}",
        ]
    return f"SELECT {', '.join(items)} FROM {dialect.name(*table)}"


def bucket(
    vendor: str,
    column: ColumnSpec,
    *,
    value_chars: int | None = None,
    months: bool = False,
    rounded: bool = False,
) -> str:
    """The value bucket of a column, never NULL; see ``functions.buckets.value_bucket``."""
    dialect = DIALECTS[vendor]
    if column.value_mode not in ("Y", "A", "B"):
        raise ValueError(f"unknown value mode {column.value_mode!r}; expected Y, A or B")
    own, kind, null = dialect.name(column.col_nm), kind_of(column.vendor_type), dialect.string(NULL_MARK)
    if column.value_mode == "B" and kind == "number":
        value = dialect.rounded.format(own) if rounded else own
        arms = "".join(
            f" WHEN {value} BETWEEN {low} AND {high} THEN {dialect.string(name)}"
            for low, high, name in RANGES
        )
        return (
            f"CASE WHEN {own} IS NULL THEN {null} WHEN {value} = 0 THEN {dialect.string(ZERO_LABEL)}"
            f"{arms} WHEN {value} < 0 THEN {dialect.string(NEGATIVE_LABEL)}"
            f" ELSE {dialect.string(OTHER_LABEL)} END"
        )
    if column.value_mode == "A" and months and kind == "time":
        return f"COALESCE({dialect.month.format(own)}, {null})"
    shown = f"COALESCE({_text(dialect, column)}, {null})"
    chars = value_chars if column.value_mode == "Y" else PREFIX_CHARS
    return shown if chars is None else dialect.prefix.format(shown, chars)


def histogram_statement(
    vendor: str, table: Sequence[str], columns: Sequence[ColumnSpec], **options
) -> str:
    """Rows (``col_no``, ``col_val``, ``col_val_cnt``) of all columns.

    With grouping sets the source scans the table once; without, once a column.
    """
    dialect = DIALECTS[vendor]
    source = dialect.name(*table)
    buckets = [bucket(vendor, c, **options) for c in columns]
    if not dialect.grouping_sets:
        return " UNION ALL ".join(
            f"SELECT {i} AS col_no, b AS col_val, {dialect.count}(*) AS col_val_cnt"
            f" FROM (SELECT {b} AS b FROM {source}) s GROUP BY b"
            for i, b in enumerate(buckets)
        )
    names = [f"b{i}" for i in range(len(buckets))]
    number = " ".join(f"WHEN GROUPING({b}) = 0 THEN {i}" for i, b in enumerate(names))
    value = " ".join(f"WHEN GROUPING({b}) = 0 THEN {b}" for b in names)
    return (
        f"SELECT CASE {number} END AS col_no, CASE {value} END AS col_val,"
        f" {dialect.count}(*) AS col_val_cnt"
        f" FROM (SELECT {', '.join(f'{b} AS {n}' for b, n in zip(buckets, names, strict=True))}"
        f" FROM {source}) s GROUP BY GROUPING SETS ({', '.join(f'({n})' for n in names)})"
    )
