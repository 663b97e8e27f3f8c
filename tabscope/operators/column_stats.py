"""Column level: non-null count, distinct count, text extremes, longest text.

Numbers, times and booleans are grouped by value first, in their own type, and only
distinct values are turned into text. One pass over such a column gives all its results.

Text columns take a keyless aggregate for extremes and lengths, and a hash aggregation of
keys for the distinct count. In one ``agg``, distinct counts next to string extremes would
copy every row once per column and sort the copies.

What a task sends of an extreme is bounded: the leading characters, cut on the map side.
Where extremes are wanted whole, the row per column is kept, and only columns whose
winner fills the leading characters are read once more: their rows that share them, spread
over tasks by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.text import INTEGER_KEY, canonical_text, distinct_key
from tabscope.functions.types import is_character
from tabscope.operators.shapes import (
    bounded_broadcast,
    long_form,
    shuffle_partitions,
    source_column,
    union_all,
)
from tabscope.plans.spec import ColumnRef, ProfileInput, name_columns, number_columns
from tabscope.session import ensure_checkpoint_dir

# Fixed value: width of the extremes in the profile tables, for ``extreme_chars``.
EXTREME_CHARS = 4000

#: Leading characters that decide which rows can hold a whole extreme.
LEADING_CHARS = 256

#: Text columns per aggregate. Five results per column stay under the 100-field limit
#: of whole-stage code generation. Batches read disjoint columns.
BATCH_COLUMNS = 18

_STATS = ("tab_cnt", "notnull_cnt", "col_kind", "max_col_val", "min_col_val", "max_len")


def column_numbers(inputs: Sequence[ProfileInput]) -> list[list[ColumnRef]]:
    return number_columns((source, source.stat_columns()) for source in inputs)


def _stats_row(chars: int) -> int:
    """Widest row of statistics: two extremes of up to four bytes a character."""
    return 2 * 4 * chars + 64


def _dtype(r: ColumnRef) -> T.DataType:
    return r.source.dtype(r.column.col_nm)


def _is_text(r: ColumnRef) -> bool:
    return is_character(_dtype(r))


def _keyed_rows(
    groups: Sequence[Sequence[ColumnRef]],
) -> dict[tuple[str, int | None], tuple[list[str], DataFrame]]:
    """Refs and long rows (``ref``, ``key``) of all tables, by key type and text decimals.

    The frames read disjoint columns, so no byte of a columnar table is read twice.
    """
    frames: dict[tuple[str, int | None], list[DataFrame]] = {}
    refs: dict[tuple[str, int | None], list[str]] = {}
    for group in groups:
        keyed: dict[tuple[str, int | None], dict[str, tuple[ColumnRef, Column]]] = {}
        for r in group:
            key_type, key = distinct_key(source_column(r), _dtype(r))
            keyed.setdefault((key_type, r.column.decimals), {})[r.ref] = (r, key)
        for family, members in keyed.items():
            rows = long_form(
                [r for r, _ in members.values()], lambda r: members[r.ref][1], "key"
            )
            frames.setdefault(family, []).append(rows)
            refs.setdefault(family, []).extend(members)
    return {family: (refs[family], union_all(parts)) for family, parts in frames.items()}


def _distinct(groups: Sequence[Sequence[ColumnRef]]) -> DataFrame:
    """``col_kind`` per ref: hash aggregation with map-side combine, one shuffle a type."""
    return union_all(
        rows.filter(F.col("key").isNotNull())
        .distinct()
        .groupBy("ref")
        .agg(F.count(F.lit(1)).alias("col_kind"))
        for _, rows in _keyed_rows(groups).values()
    )


def distinct_counts(inputs: Sequence[ProfileInput]) -> DataFrame:
    """Exact distinct count of every column that holds at least one value."""
    groups = column_numbers(inputs)
    return name_columns(_distinct(groups), groups)


def _one_row_stats(one_row: DataFrame, refs: Sequence[str]) -> DataFrame:
    """A row of structs, one per ref, as a row per ref with the columns of a statistic."""
    rows, count, kinds, highest, lowest, longest = (F.col(f"stats.col{i}") for i in range(1, 7))
    return one_row.unpivot([], list(refs), "ref", "stats").select(
        F.col("ref").cast("int").alias("ref"),
        rows.alias("tab_cnt"),
        count.alias("notnull_cnt"),
        kinds.alias("col_kind"),
        highest.alias("max_col_val"),
        lowest.alias("min_col_val"),
        longest.alias("max_len"),
    )


def _facts(rows: DataFrame, key_type: str, decimals: int | None, refs: Sequence[str] | None) -> DataFrame:
    """Value counts of one key type as rows, with what each adds to its column's statistics.

    Integers of one sign and length stand in the order of their texts or in its reverse, so
    all that the extremes need is the least and the greatest of each such group. For other
    types every value is a row; ``refs`` names the columns whose text is wanted.
    """
    counts = rows.groupBy("ref", "key").agg(F.count(F.lit(1)).alias("n"))
    key = F.col("key")
    held = F.when(key.isNotNull(), F.col("n")).alias("held")
    if key_type == INTEGER_KEY:
        size = F.length(key.cast("string")).alias("len")
        shapes = counts.select(F.col("ref").alias("of"), "key", "n", held, size)
        return shapes.groupBy("of", "len", (key < 0).alias("negative")).agg(
            F.sum("n").alias("n"),
            F.sum("held").alias("held"),
            F.count("key").alias("kinds"),
            F.max("key").cast("string").alias("high"),
            F.min("key").cast("string").alias("low"),
        ).select("of", "n", "held", "kinds", "high", "low", "len")
    text = canonical_text(key, rows.schema["key"].dataType, decimals)
    if refs is not None:
        text = F.when(F.col("ref").isin(*refs), text)
    return counts.select(
        F.col("ref").alias("of"), "n", held, key.isNotNull().cast("bigint").alias("kinds"), text.alias("txt")
    ).select("of", "n", "held", "kinds", F.col("txt").alias("high"), F.col("txt").alias("low"), F.length("txt").alias("len"))


def _by_value(
    families: dict[tuple[str, int | None], tuple[list[str], DataFrame]], batch_columns: int
) -> DataFrame:
    """All statistics of columns that are not text, from their value counts.

    The extremes are keyless aggregates with a condition per column: grouped by column,
    extremes of strings would sort all distinct values. Text is made per key type, and
    the columns of all types share an aggregate. Columns go by type, so that a batch reads
    the exchanges of its own types only and makes the text of its own columns.
    """
    planned = [(family, ref) for family, (refs, _) in families.items() for ref in refs]
    parts = []
    for i in range(0, len(planned), batch_columns):
        mine: dict[tuple[str, int | None], list[str]] = {}
        for family, ref in planned[i : i + batch_columns]:
            mine.setdefault(family, []).append(ref)
        every = union_all(
            _facts(families[f][1], *f, refs if len(refs) < len(families[f][0]) else None)
            for f, refs in mine.items()
        )
        batch = [ref for refs in mine.values() for ref in refs]
        parts.append(_one_row_stats(every.agg(*[_of_column(r).alias(r) for r in batch]), batch))
    return union_all(parts)


def _of_column(ref: str) -> Column:
    def own(name: str) -> Column:
        return F.when(F.col("of") == ref, F.col(name))

    return F.struct(
        F.sum(own("n")),
        F.sum(own("held")),
        F.sum(own("kinds")),
        F.max(own("high")),
        F.min(own("low")),
        F.max(own("len")),
    )


def _text_batch(batch: Sequence[ColumnRef], chars: int) -> DataFrame:
    """A row per text column: its plain aggregates, extremes cut to ``chars``."""

    def aggregates(r: ColumnRef) -> Column:
        text = source_column(r)
        leading = F.substring(text, 1, chars)
        return F.struct(
            F.count(F.lit(1)),
            F.count(text),
            F.lit(None).cast("bigint"),
            F.max(leading),
            F.min(leading),
            F.max(F.length(text)),
        )

    one_row = batch[0].source.frame.agg(*[aggregates(r).alias(r.ref) for r in batch])
    return _one_row_stats(one_row, [r.ref for r in batch])


def _plain_text(
    groups: Sequence[Sequence[ColumnRef]], batch_columns: int, chars: int
) -> DataFrame:
    return union_all(
        _text_batch(group[i : i + batch_columns], chars)
        for group in groups
        for i in range(0, len(group), batch_columns)
    )


def _whole_extremes(groups: Sequence[Sequence[ColumnRef]], leading: DataFrame) -> DataFrame:
    """(ref, highest, lowest): whole texts, from the rows that share the leading part."""
    texts = union_all(long_form(group, source_column, "txt") for group in groups)
    winners = leading.select(
        F.col("ref").cast("string").alias("ref"),
        F.col("max_col_val").alias("high"),
        F.col("min_col_val").alias("low"),
    )
    n_columns = sum(map(len, groups))
    start = F.substring("txt", 1, LEADING_CHARS)
    near = (
        texts.join(bounded_broadcast(winners, n_columns, _stats_row(LEADING_CHARS)), "ref")
        .withColumn("in_high", start == F.col("high"))
        .withColumn("in_low", start == F.col("low"))
        .where("in_high OR in_low")
    )
    salt = F.pmod(F.xxhash64("txt"), F.lit(shuffle_partitions(texts.sparkSession))).alias("salt")
    spread = near.groupBy("ref", salt).agg(
        F.max(F.when(F.col("in_high"), F.col("txt"))).alias("highest"),
        F.min(F.when(F.col("in_low"), F.col("txt"))).alias("lowest"),
    )
    return spread.groupBy(F.col("ref").cast("int").alias("ref")).agg(
        F.max("highest").alias("highest"), F.min("lowest").alias("lowest")
    )


def _text_stats(
    groups: Sequence[Sequence[ColumnRef]], batch_columns: int, chars: int | None
) -> DataFrame:
    n_columns = sum(map(len, groups))
    kinds = _distinct(groups).select(F.col("ref").cast("int").alias("ref"), "col_kind")
    plain = _plain_text(groups, batch_columns, LEADING_CHARS if chars is None else chars)
    if chars is not None:
        joined = plain.drop("col_kind").join(bounded_broadcast(kinds, n_columns), "ref", "left")
        return joined.select("ref", *_STATS)
    ensure_checkpoint_dir(plain.sparkSession)
    plain = plain.checkpoint()
    full = (F.length("max_col_val") == LEADING_CHARS) | (F.length("min_col_val") == LEADING_CHARS)
    cut = {str(r.ref) for r in plain.where(full).select("ref").collect()}  # some of the plan's columns
    out = plain.drop("col_kind").join(bounded_broadcast(kinds, n_columns), "ref", "left")
    long = [g for group in groups if (g := [r for r in group if r.ref in cut])]
    if long:
        whole = _whole_extremes(long, plain.where(full))
        out = out.join(whole, "ref", "left").withColumns(
            {
                "max_col_val": F.coalesce("highest", "max_col_val"),
                "min_col_val": F.coalesce("lowest", "min_col_val"),
            }
        )
    return out.select("ref", *_STATS)


def column_stats(
    inputs: Sequence[ProfileInput],
    batch_columns: int = BATCH_COLUMNS,
    with_row_count: bool = False,
    extreme_chars: int | None = None,
) -> DataFrame:
    """One row per structured column. Extremes compare as text: '9' is above '10'.

    ``extreme_chars`` cuts the extremes of text, to EXTREME_CHARS for the profile tables;
    None keeps them whole. ``with_row_count`` adds the ``tab_cnt`` of the table, which the same passes count.
    """
    groups = column_numbers(inputs)
    if not groups:
        raise ValueError("no column to profile")
    n_columns = sum(map(len, groups))
    texts = [t for g in groups if (t := [r for r in g if _is_text(r)])]
    others = [o for g in groups if (o := [r for r in g if not _is_text(r)])]
    facts = []
    if others:
        facts.append(_by_value(_keyed_rows(others), batch_columns))
    if texts:
        facts.append(_text_stats(texts, batch_columns, extreme_chars))

    # Every planned column has a row, also in a table without rows.
    planned = inputs[0].frame.sparkSession.range(n_columns).select(
        F.col("id").cast("int").alias("ref")
    )
    found = union_all(facts)
    if extreme_chars is not None:
        found = bounded_broadcast(found, n_columns, _stats_row(extreme_chars))
    stats = planned.join(found, "ref", "left")

    def counted(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint")).alias(name)

    columns = [
        "ref",
        counted("notnull_cnt"),
        counted("col_kind"),
        "max_col_val",
        "min_col_val",
        F.coalesce("max_len", F.lit(0)).alias("max_len"),
    ]
    if with_row_count:
        columns.append(counted("tab_cnt"))
    return name_columns(stats.select(*columns), groups)
