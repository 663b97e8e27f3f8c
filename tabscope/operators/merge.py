"""Keyed merges of a master table: update by key, insert-or-update.

:func:`update_by_key` and :func:`upsert` join and give the whole new table: they work on any
storage. Where the master is a table of a format that can change single rows,
:func:`merge_update` and :func:`merge_upsert` build Spark's MERGE INTO with the same rule
per column, and only changed rows are written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, MergeIntoWriter, SparkSession
from pyspark.sql import functions as F


def update_by_key(
    master: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    run_ts: Column | None = None,
) -> DataFrame:
    """Overwrite ``columns`` of the rows whose key occurs in ``facts``.

    A matched row takes the new value even when that is NULL; an unmatched row is left
    as it is. ``up_dt`` of matched rows becomes ``run_ts``.
    """
    new = facts.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    joined = master.join(new, list(keys), "left")
    updates: dict[str, Column] = {c: F.col(f"_new_{c}") for c in columns}
    if run_ts is not None:
        updates["up_dt"] = run_ts
    return joined.select(
        *[
            F.when(F.col("_hit"), updates[c]).otherwise(F.col(c)).alias(c) if c in updates else c
            for c in master.columns
        ]
    )


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    refreshed: Sequence[str],
    on_conflict: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert-or-update by key with a rule per column.

    On a conflict the ``refreshed`` columns come from ``incoming``, those of
    ``on_conflict`` from the given expression, all others stay. Columns that
    ``incoming`` lacks are NULL in inserted rows.
    """
    on_conflict = dict(on_conflict or {})
    old = existing.select(
        *keys,
        *[F.col(c).alias(f"_old_{c}") for c in existing.columns if c not in keys],
        F.lit(True).alias("_in_old"),
    )
    new = incoming.select(
        *keys,
        *[F.col(c).alias(f"_new_{c}") for c in incoming.columns if c not in keys],
        F.lit(True).alias("_in_new"),
    )
    both = old.join(new, list(keys), "full_outer")
    in_old, in_new = F.col("_in_old"), F.col("_in_new")

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        before = F.col(f"_old_{name}")
        after = F.col(f"_new_{name}") if name in incoming.columns else F.lit(None)
        if name in on_conflict:
            conflict = on_conflict[name]
        else:
            conflict = after if name in refreshed else before
        return (
            F.when(in_old & in_new, conflict).when(in_new, after).otherwise(before).alias(name)
        )

    return both.select(*[merged(c) for c in existing.columns])


_TARGET, _SOURCE = "target", "source"


def _columns(spark: SparkSession, target: str) -> list[str]:
    return spark.table(target).columns


def _same(keys: Sequence[str]) -> Column:
    """Equality of the keys, none of which is NULL in a master."""
    out = F.lit(True)
    for key in keys:
        out = out & (F.col(f"{_TARGET}.{key}") == F.col(f"{_SOURCE}.{key}"))
    return out


def merge_update(
    target: str,
    facts: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    run_ts: Column | None = None,
) -> MergeIntoWriter:
    """The MERGE INTO of :func:`update_by_key`; run it by ``merge()``."""
    updates = {c: F.col(f"{_SOURCE}.{c}") for c in columns}
    if run_ts is not None:
        updates["up_dt"] = run_ts
    source = facts.select(*keys, *columns).alias(_SOURCE)
    return source.mergeInto(target, _same(keys)).whenMatched().update(updates)


def merge_upsert(
    target: str,
    incoming: DataFrame,
    keys: Sequence[str],
    refreshed: Sequence[str],
    on_conflict: Mapping[str, Column] | None = None,
    columns: Sequence[str] | None = None,
) -> MergeIntoWriter:
    """The MERGE INTO of :func:`upsert`; run it by ``merge()``.

    ``columns`` are those of the target; by default they are asked of the catalog.
    """
    names = list(columns or _columns(incoming.sparkSession, target))
    given = dict(on_conflict or {})
    updates = {
        c: given.get(c, F.col(f"{_SOURCE}.{c}") if c in incoming.columns else F.lit(None))
        for c in names
        if c not in keys and (c in given or c in refreshed)
    }
    inserts = {c: F.col(f"{_SOURCE}.{c}") if c in incoming.columns else F.lit(None) for c in names}
    merged = incoming.alias(_SOURCE).mergeInto(target, _same(keys))
    return merged.whenMatched().update(updates).whenNotMatched().insert(inserts)
