"""A registered query: the Spark side and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification.tables import Frames


@dataclass(frozen=True)
class Check:
    """``build`` makes the Spark result; ``sql`` is the equivalent, or None."""

    build: Callable[[Frames], DataFrame]
    sql: str | None = None


def comparable(df: DataFrame, *columns: str) -> DataFrame:
    """Columns in the types both engines print alike: no decimals, no timestamps."""
    picked = df.select(*columns) if columns else df
    out = []
    for f in picked.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return picked.select(*out)


def sql_stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
