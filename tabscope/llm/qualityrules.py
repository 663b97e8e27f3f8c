"""Quality rules whose thresholds adapt to language and source.

Per document a few counts; per (lang, source) a quantile sketch of each rate: counts in
buckets that grow by 2 %, so a quantile is right to 2 % of its value. Sketches merge by
adding counts: those of a language's sources give its own, and those of all languages that
of the corpus.

A rate is odd beyond its fence: a high quantile of the group, and above it :data:`SPREADS`
times the distance from the median to it; for the letters a word there is a lower fence as
well. A small group is drawn towards its language, and a small language towards the
corpus: a fence is the mean of its own and the wider one, weighted by its documents against
:data:`LEAST_DOCUMENTS`. Where a group has no spread at all, the fence is a tolerance above
the median that shrinks with the square root of its documents: what few documents can not
show to be odd stays. Fences are joined to the documents and all rules decide together.

Defined results: null, empty and blank texts have no words and fail the base rules; null
languages and sources are groups of their own; repeated rows are judged alike; an empty
table gives no rows. Buckets combine on the map side, so a group with a third of the
documents costs a row per task and bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import map_batches, measured_bytes, scratch_table, small_side

#: Characters that running text rarely has.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
#: Documents that weigh as much as the wider group's fence.
LEAST_DOCUMENTS = 200
GROWTH = 1.02
SMALLEST = 1e-4
SPREADS = 3.0


@dataclass(frozen=True)
class Rate:
    """Quantile the fence starts from, and the tolerance of a group without documents."""

    quantile: float
    tolerance: float
    both_sides: bool = False


#: Symbols are rare where they are text, and fill the tenth of a source that is not; lines
#: repeat a little in many good documents of a few sources.
RATES = {
    "symbols_a_word": Rate(0.9, 0.15),
    "repeated_lines": Rate(0.99, 0.3),
    "letters_a_word": Rate(0.9, 1.5, both_sides=True),
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    # A word's number is the place of its first occurrence.
    ids = np.fromiter(map({}.setdefault, words, count()), np.int64, len(words))
    base = len(words)
    if base < 1 << 12:  # five numbers fit 63 bits
        key = ids[:n].copy()
        for j in range(1, WINDOW):
            key *= base
            key += ids[j : j + n]
    else:
        two = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
        four = np.unique(two[:-2] * base + two[2:], return_inverse=True)[1]
        key = four[:n] * base + ids[4 : 4 + n]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(key, np.unique(twice)))
    edges = np.zeros(len(words) + 1, np.int64)
    edges[at] += 1
    edges[at + WINDOW] -= 1
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(t) for t in batch.column(3).to_pylist()]
            made = np.array(rows, np.int64).reshape(-1, len(_COUNTS)).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(np.ascontiguousarray(c)) for c in made)],
                names=["doc_id", "lang", "source", *_COUNTS],
            )

    rows = documents.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    kept = [f"{name} {kind}" for name, kind in rows.dtypes[:3]]
    return map_batches(rows, run, ", ".join([*kept, *(f"{c} long" for c in _COUNTS)]))


def rate(name: str) -> Column:
    over = {
        "symbols_a_word": ("n_symbols", "n_words"),
        "repeated_lines": ("n_dup_lines", "n_lines"),
        "letters_a_word": ("word_chars", "n_words"),
    }[name]
    return F.when(F.col(over[1]) > 0, F.col(over[0]) / F.col(over[1])).otherwise(0.0)


def _bucket(value: Column) -> Column:
    return F.when(value <= SMALLEST, 0).otherwise(
        F.ceil(F.log(value / SMALLEST) / F.log(F.lit(GROWTH)))
    ).cast("int")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n): a mergeable sketch per group and rate."""
    every = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rate"), _bucket(rate(r)).alias("bucket")) for r in RATES])
    )
    return (
        rows.where("n_words > 0")
        .select("lang", "source", every.alias("s"))
        .select("lang", "source", "s.rate", "s.bucket")
        .groupBy("lang", "source", "rate", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, rate, documents, high, low) from sketches; a window sees one sketch's buckets.

    ``low`` is null for rates without a lower fence.
    """
    part = Window.partitionBy(*keys, "rate")
    below = part.orderBy("bucket")
    value = F.when(F.col("bucket") == 0, 0.0).otherwise(
        F.lit(SMALLEST) * F.pow(F.lit(GROWTH), F.col("bucket"))
    )
    placed = sketch.select(
        *keys,
        "rate",
        value.alias("value"),
        F.sum("n").over(below).alias("upto"),
        F.sum("n").over(part).alias("documents"),
    )
    of = lambda get: _by_rate({name: F.lit(get(rate)) for name, rate in RATES.items()})
    level = of(lambda r: r.quantile)

    def at(share: Column) -> Column:
        reached = F.col("upto") >= share * F.col("documents")
        return F.min(F.when(reached, F.col("value")))

    found = placed.groupBy(*keys, "rate").agg(
        F.first("documents").alias("documents"),
        at(1 - level).alias("lower"),
        at(F.lit(0.5)).alias("middle"),
        at(level).alias("upper"),
    )
    room = of(lambda r: r.tolerance) * F.sqrt(
        LEAST_DOCUMENTS / (F.col("documents") + LEAST_DOCUMENTS)
    )
    upper, lower, middle = F.col("upper"), F.col("lower"), F.col("middle")
    high = F.greatest(upper + SPREADS * (upper - middle), middle + room)
    low = F.least(lower - SPREADS * (middle - lower), middle - room)
    return found.select(
        *keys,
        "rate",
        "documents",
        high.alias("high"),
        F.when(of(lambda r: r.both_sides), low).alias("low"),
    )


def _by_rate(values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(F.col("rate") == name, value).otherwise(out)
    return out


def _drawn(own: DataFrame, wider: DataFrame, same: Column) -> DataFrame:
    """Fences of ``own`` drawn towards those of ``wider(w_rate, w_high, w_low)``."""
    weight = F.col("documents") / (F.col("documents") + LEAST_DOCUMENTS)
    both = own.join(wider, same)
    return both.select(
        *[c for c in own.columns if c not in ("high", "low")],
        *[
            (weight * F.col(c) + (1 - weight) * F.col(f"w_{c}")).alias(c)
            for c in ("high", "low")
        ],
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """(lang, source, two columns per rate): the fences each group is judged by."""
    sketch = scratch_table(sketches(rows), "quality-sketches")
    wider = lambda f: f.withColumnsRenamed(
        {c: f"w_{c}" for c in ("lang", "rate", "documents", "high", "low")}
    )
    corpus = F.broadcast(wider(fences(merged(sketch))))  # a row per rate
    rate_too = F.col("rate") == F.col("w_rate")
    language = _drawn(fences(merged(sketch, "lang"), "lang"), corpus, rate_too)
    same = F.col("lang").eqNullSafe(F.col("w_lang")) & rate_too
    group = _drawn(fences(sketch, "lang", "source"), wider(language), same)
    columns = [
        F.max(F.when(F.col("rate") == r, F.col(side))).alias(f"_{side}_{r}")
        for r in RATES
        for side in ("high", "low")
    ]
    return group.groupBy("lang", "source").agg(*columns)


def judged(documents: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    rows = scratch_table(measured(documents), "quality-counts")
    bounds = scratch_table(thresholds(rows), "quality-thresholds").select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        *[f"_{side}_{r}" for r in RATES for side in ("high", "low")],
    )
    width = measured_bytes(bounds, "_lang", "_source")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    beyond = F.lit(False)
    for r in RATES:
        for out in (rate(r) > F.col(f"_high_{r}"), rate(r) < F.col(f"_low_{r}")):
            beyond = beyond | F.coalesce(out, F.lit(False))
    return rows.join(small_side(bounds, 1, width), same, "left").select(
        "doc_id",
        *_COUNTS[:5],
        failed.alias("base_failed"),
        (~failed & ~beyond).alias("kept"),
    )
