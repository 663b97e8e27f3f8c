"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

from pyspark.sql import DataFrame

from verification.tables import TABLES


def connect(sf_dir: str):
    """A checking connection with the given tables as views."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, con, query: str) -> str | None:
    """None when both sides hold the same rows, else what is wrong."""
    found = con.execute(query)
    names = [d[0] for d in found.description]
    expected = _bag(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} against {sorted(names)}"
    actual = _bag(df.columns, df.collect())
    if actual == expected:
        return None
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only here {str(list((actual - expected).items())[:3])[:600]}; "
        f"only there {str(list((expected - actual).items())[:3])[:600]}"
    )
