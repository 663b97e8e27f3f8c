"""Mixing sources to target weights along a curriculum that changes over training.

Every source gets a target in words: its share, by weight, of a budget; a target stops at
a multiple of the source's size and the excess is shared again by weight. A source's
documents are taken whole, in hashed order, pass after pass. The last pass passes over
documents that are longer than what is open of the target; when no other one fits, what
it leaves open goes to the one document nearest in size.

When they are taken follows the source's weight schedule, a weight that changes along
training time from 0 to 1. Its integral, scaled to the target, is the source's cumulative
demand; the time at which demand reaches the words before the middle of a document is
that document's training position. Rows are range-sorted by position.

Only DataFrame functions: one scan for sizes, everything after on narrow rows. Prefix
sums run over buckets of some ten thousand documents of one source, and bucket offsets
over the buckets, so no task sees a whole source.

Defined results: a null or blank text has size 0 and is taken 0 words; a null source is a
source of its own, after all others; repeated rows are documents of their own; a source
without words has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import (
    WORD,
    content_order,
    identified,
    keeping_names,
    measured_bytes,
    scratch_table,
    small_side,
)
from tabscope.operators.ranking import global_row_number

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_TIMES = 2
#: Weight over training time, relative to its mean, at equally spaced times, for each of
#: WEIGHTS: the heaviest source fades out, the lightest fades in, the other stays.
SCHEDULES = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5), (1.0, 1.0, 1.0))
BUCKET_ROWS = 10_000
ROW = "_tabscope_row"
SEED = 42
#: The hashed order: by what the mix reads of a document, then by all it holds. Rows that
#: agree in all of it are alike, so that ROW decides nothing.
ORDER = ("order", "tie", "other", ROW)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, budget: float) -> float:
    """The words per unit of weight at which capped targets use up the budget.

    ``sources(weight, cap)``. A round fixes every source that is above its cap and shares
    the rest again; it sends one row to the driver.
    """
    level, fixed = 0.0, -1
    while True:
        above = F.col("cap") <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.count_if(above).alias("fixed"),
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)).alias("caps"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        if row.fixed == fixed or not row.weights:
            return level
        level, fixed = (budget - row.caps) / row.weights, row.fixed


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Per source of ``sizes(source, size)``: place, docs, source_size, weight, target."""
    sums = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    # Scratch first: ranking sorts, and a sort reads its input twice.
    placed = global_row_number(
        scratch_table(sums, "mixing-sources"), [F.asc_nulls_last("source")], "place"
    )
    kind = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), kind + 1)
    placed = scratch_table(
        placed.withColumn("kind", kind)
        .withColumn("weight", weight)
        .withColumn("cap", MOST_TIMES * F.col("source_size")),
        "mixing-targets",
    )
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(placed, BUDGET * total) if total else 0.0
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return placed.withColumn("target", target)


def schedule_time(share: Column, kind: Column, schedules: Sequence[Sequence[float]]) -> Column:
    """Training time at which a schedule has spent ``share`` of its integral.

    Schedules are linear between equally spaced times, so the integral is quadratic in
    each piece and is inverted in closed form.
    """
    out = F.lit(None).cast("double")
    for number, values in enumerate(schedules):
        pieces = len(values) - 1
        areas = [(a + b) / 2 / pieces for a, b in zip(values, values[1:], strict=False)]
        spent = share * sum(areas)
        time = F.lit(1.0)
        for i in reversed(range(pieces)):
            rest = spent - sum(areas[:i])
            slope = (values[i + 1] - values[i]) * pieces
            root = F.sqrt(F.greatest(F.lit(values[i] ** 2) + 2 * slope * rest, F.lit(0.0)))
            below = F.lit(values[i]) + root
            inside = F.lit(i / pieces) + F.when(below > 0, 2 * rest / below).otherwise(0.0)
            time = F.when(spent <= sum(areas[: i + 1]), inside).otherwise(time)
        out = F.when(kind == number, time).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def running_sums(dealt: DataFrame) -> DataFrame:
    """``dealt(place, bucket, order, ROW, size, ...)`` with the words ``before`` each document."""
    sums = dealt.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.select(
        "place", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    within = (
        Window.partitionBy("place", "bucket")
        .orderBy(*ORDER)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    return dealt.join(offsets, ["place", "bucket"]).withColumn("before", before).drop("offset")


def last_pass(summed: DataFrame, count: int) -> DataFrame:
    """(ROW, within): what the last pass takes, and the words it takes from a source before.

    A round takes documents in hashed order up to the first that does not fit. That one and
    all others longer than the gap are set aside, and the next round goes on behind it with
    new sums, until no document is left that fits; a round halves what is left, about. The
    gap that remains goes to the one document nearest to it in size.
    """
    narrow = ["place", "bucket", *ORDER, "size"]
    gap, ended = F.col("rest").alias("gap"), F.lit(0).cast("long").alias("ended")
    others = summed.where("rest > 0")
    ends = scratch_table(others.select("place", gap, ended).distinct(), "mixing-ends")
    left = running_sums(others.where("size <= rest").select(*narrow, gap, ended))
    taken = None
    while True:
        fits = F.col("before") + F.col("size") <= F.col("gap")
        step = scratch_table(left.withColumn("fits", fits), "mixing-round")
        some = step.where("fits").select(ROW, (F.col("ended") + F.col("before")).alias("within"))
        taken = some if taken is None else taken.unionAll(some)
        given = step.where("fits").groupBy("place").agg(F.sum("size").alias("given"))
        ends = scratch_table(
            ends.join(small_side(given, count, 32), "place", "left").select(
                "place",
                (F.col("gap") - F.coalesce("given", F.lit(0))).alias("gap"),
                (F.col("ended") + F.coalesce("given", F.lit(0))).alias("ended"),
            ),
            "mixing-ends",
        )
        rest = step.where("not fits").select(*narrow)
        rest = rest.join(small_side(ends, count, 64), "place").where("size <= gap")
        if rest.isEmpty():
            break
        left = running_sums(rest)
    nearest = F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("miss"), *ORDER))
    closing = (
        others.where("size > 0")
        .join(taken.select(ROW), ROW, "left_anti")
        .join(small_side(ends, count, 64), "place")
        .where("abs(size - gap) < gap")
        .groupBy("place", "ended")
        .agg(nearest.alias("nearest"))
        .select(F.col(f"nearest.{ROW}").alias(ROW), F.col("ended").alias("within"))
    )
    return taken.unionAll(closing)


def plan(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
) -> DataFrame:
    """Per row of ``documents(doc_id, text, source, ROW)``: size, target, copies, positions."""
    order, tie = content_order(documents, SEED, "doc_id", "text", "source")
    other, _ = content_order(documents, SEED)
    rows = scratch_table(
        documents.select(
            "doc_id",
            "source",
            ROW,
            order.alias("order"),
            tie.alias("tie"),
            other.alias("other"),
            word_count(F.col("text")).alias("size"),
        ),
        "mixing-sizes",
    )
    every = scratch_table(targets(rows, weights), "mixing-plan")
    count = every.count()
    width = measured_bytes(every, "source")
    source = every.select(
        F.col("source").alias("_source"), "place", "docs", "kind", "source_size", "target"
    )
    buckets = F.greatest(F.ceil(F.col("docs") / BUCKET_ROWS), F.lit(1))
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    dealt = (
        rows.join(small_side(source, 1, width), F.col("source").eqNullSafe(F.col("_source")))
        .drop("source", "_source")
        .withColumn("bucket", F.pmod("order", buckets))
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .drop("docs")
    )
    summed = scratch_table(running_sums(dealt), "mixing-sums")
    last = scratch_table(last_pass(summed, count), "mixing-last")
    summed = summed.join(last, ROW, "left")
    copies = F.least(F.col("whole") + F.col("within").isNotNull().cast("long"), F.lit(MOST_TIMES))
    begun = lambda c: F.when(F.col("whole") > c, F.col("before")).otherwise(F.col("within"))
    middle = lambda c: c * F.col("source_size") + begun(c) + F.col("size") / 2
    share = lambda c: F.least(middle(c) / F.col("target"), F.lit(1.0))
    times = [
        F.when(F.col("copies") > c, schedule_time(share(F.lit(c)), F.col("kind"), schedules))
        for c in range(MOST_TIMES)
    ]
    return (
        summed.withColumn("copies", copies)
        .select(
            "doc_id",
            *ORDER,
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
            F.array_compact(F.array(*times)).alias("positions"),
        )
    )


def mix(documents: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken and first position, sorted by position."""
    rows = identified(documents.select("doc_id", "text", "source"), ROW)
    made = scratch_table(plan(rows, **options), "mixing-result")
    first = F.try_element_at("positions", F.lit(1)).alias("position")
    made = made.withColumn("position", first).orderBy(F.asc_nulls_last("position"), *ORDER)
    return made.select("doc_id", "size", "source_size", "target", "taken", "position")


@keeping_names
def mixed(documents: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, sorted by training position."""
    tagged = identified(documents, ROW)
    made = plan(tagged, **options).where("copies > 0")
    place = [F.col(c).alias(f"_tabscope_{c}") for c in ORDER[:-1]]
    places = scratch_table(
        made.select(ROW, *place, F.explode("positions").alias("_tabscope_position")),
        "mixing-positions",
    )
    order = ["_tabscope_position", *[f"_tabscope_{c}" for c in ORDER[:-1]], ROW]
    return tagged.join(places, ROW).orderBy(*order).drop(*order)
