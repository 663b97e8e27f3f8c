"""The profile levels as SQL, generated from the table schemas.

Written on its own: one SELECT per column, seven replacements per pattern, integer
shares. It shares no expression with the library it checks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from verification.tables import SCHEMAS

NULL = "'##'"
_UNSTRUCTURED = ("FLOAT[]",)

# The replacement steps of the executed and the documented pattern rule.
_TAIL = (("[a-z]", "c"), ("[가-힣]", "가"), ("[.]", "*"), (" ", "#"), ("[^NCc가*#]", "$"))
STEPS = {
    "executed": (("[0-9]", "N"), ("[A-Z]", "C"), *_TAIL),
    "documented": (("[A-Z]", "C"), ("[0-9]", "N"), *_TAIL),
}

# Labels of the range buckets.
_RANGES = (
    (1, 100, "1~100"), (101, 1000, "101~1000"), (1001, 10000, "1001~10000"),
    (10001, 100000, "10001~100000"), (100001, 1000000, "100001~1000000"),
)


def text(col: str, sql_type: str) -> str:
    if sql_type == "VARCHAR":
        return col
    if sql_type == "DOUBLE":
        return f"CAST(CAST({col} AS DECIMAL(18, 2)) AS VARCHAR)"
    return f"CAST({col} AS VARCHAR)"


def pattern(expr: str, mode: str = "executed") -> str:
    return reduce(
        lambda inner, step: f"regexp_replace({inner}, '{step[0]}', '{step[1]}', 'g')",
        STEPS[mode],
        expr,
    )


def ranges(col: str, rounded: bool = False) -> str:
    v = f"round({col})" if rounded else col
    arms = " ".join(f"WHEN {v} >= {lo} AND {v} <= {hi} THEN '{name}'" for lo, hi, name in _RANGES)
    return (
        f"CASE WHEN {col} IS NULL THEN {NULL} WHEN {v} < 0 THEN '0미만' WHEN {v} = 0 THEN '0' "
        f"{arms} ELSE '1000000초과' END"
    )


def bucket(col: str, sql_type: str, mode: str, chars: int | None = None, rounded: bool = False) -> str:
    if mode == "B" and sql_type in ("DOUBLE", "BIGINT", "INTEGER"):
        return ranges(col, rounded)
    whole = f"ifnull({text(col, sql_type)}, {NULL})"
    if mode == "Y":
        return whole if chars is None else f"left({whole}, {chars})"
    return f"left({whole}, 6)"


def structured(table: str) -> dict[str, str]:
    return {c: t for c, t in SCHEMAS[table].items() if t not in _UNSTRUCTURED}


def text_columns(table: str) -> list[str]:
    return [c for c, t in SCHEMAS[table].items() if t == "VARCHAR"]


def default_modes(table: str) -> dict[str, str]:
    return {c: "Y" for c in text_columns(table)}


def stats(table: str, chars: int | None = None) -> str:
    cut = (lambda e: e) if chars is None else (lambda e: f"left({e}, {chars})")
    parts = []
    for c, t in structured(table).items():
        shown = text(c, t)
        parts.append(
            f"SELECT '{table}' AS tab_nm, '{c}' AS col_nm, count({c}) AS notnull_cnt, "
            f"count(DISTINCT {c}) AS col_kind, {cut(f'max({shown})')} AS max_col_val, "
            f"{cut(f'min({shown})')} AS min_col_val, "
            f"CAST(ifnull(max(length({shown})), 0) AS INTEGER) AS max_len FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


def values(
    table: str,
    modes: Mapping[str, str] | None = None,
    chars: int | None = None,
    rounded: bool = False,
) -> str:
    modes = default_modes(table) if modes is None else modes
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS tab_nm, '{c}' AS col_nm, "
        f"{bucket(c, SCHEMAS[table][c], m, chars, rounded)} AS col_val, count(*) AS col_val_cnt "
        f"FROM {table} GROUP BY 3"
        for c, m in modes.items()
    )


def patterns(
    table: str, columns: Sequence[str] | None = None, chars: int | None = None, mode: str = "executed"
) -> str:
    """Pattern counts read straight from a table."""
    cut = (lambda c: c) if chars is None else (lambda c: f"left({c}, {chars})")
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS tab_nm, '{c}' AS col_nm, {pattern(cut(c), mode)} AS col_pat, "
        f"count(*) AS col_pat_cnt FROM {table} WHERE {c} IS NOT NULL GROUP BY 3"
        for c in (text_columns(table) if columns is None else columns)
    )


def patterns_of(histogram: str, mode: str = "executed") -> str:
    """Pattern counts of a value histogram."""
    return (
        f"SELECT tab_nm, col_nm, {pattern('col_val', mode)} AS col_pat, "
        f"CAST(sum(col_val_cnt) AS BIGINT) AS col_pat_cnt FROM ({histogram}) WHERE col_val <> {NULL} "
        "GROUP BY ALL"
    )


def shared(counts: str) -> str:
    """Add the share: hundredths of a percent, rounded half up, with two places."""
    total = "sum(col_pat_cnt) OVER (PARTITION BY tab_nm, col_nm)"
    return f"""
SELECT tab_nm, col_nm, col_pat, col_pat_cnt,
       (h // 100)::VARCHAR || '.' || lpad((h % 100)::VARCHAR, 2, '0') AS col_pat_rt
FROM (SELECT *, (col_pat_cnt * 20000 + {total}) // (2 * {total}) AS h FROM ({counts}))"""


def samples(histogram: str) -> str:
    return f"""
SELECT tab_nm, col_nm, string_agg(col_val, ' | ' ORDER BY col_val_cnt DESC, col_val) AS sample_data
FROM (SELECT * FROM ({histogram}) WHERE col_val <> {NULL}
      QUALIFY row_number() OVER (PARTITION BY tab_nm, col_nm
                                 ORDER BY col_val_cnt DESC, col_val) <= 3)
GROUP BY tab_nm, col_nm"""


def top_pattern(counts: str) -> str:
    return f"""
SELECT tab_nm, col_nm, col_pat AS top_col_pat FROM ({counts})
QUALIFY row_number() OVER (PARTITION BY tab_nm, col_nm ORDER BY col_pat_cnt DESC, col_pat) = 1"""


def union(parts: Iterable[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def column_list(tables: Iterable[str], only_structured: bool = False) -> str:
    """(tab_nm, col_nm) of tables as a VALUES list."""
    rows = ", ".join(
        f"('{t}', '{c}')"
        for t in tables
        for c in (structured(t) if only_structured else SCHEMAS[t])
    )
    return f"(VALUES {rows}) AS c(tab_nm, col_nm)"
