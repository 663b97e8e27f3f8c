"""Quality classifier by co-training two views of a document.

One view sees the text only: how often words of each shape occur, repeats, capitals,
symbols. The other sees metadata only: language, source, length and line layout. Both are
fitted from sums: a linear discriminant from counts, means and second moments of each
class, and for language and source a log-odds a value from a grouped table. So every
labelled document counts, and every document a view is sure of.

The unlabelled documents are dealt to as many slices as there are rounds. In a round both
views score one slice; each document that a view is sure of, weighted by how sure, is
added to the sums of the other view, and both are fitted again. After the last round every
unlabelled document has been scored once for the other view. Each view is calibrated on
labelled documents that are in no sum, and a logistic fit on the calibrated views scores
every document.

Features are written once; rounds read them, not the texts. A task sends sums of fixed
size and the weights of the languages and sources it has met.

Defined results: null, empty and blank texts have text features 0; null languages,
sources and lengths are values of their own; a document labelled several times takes its
lowest label; null labels and labels of unknown documents count for nothing; documents
without an id take part unlabelled; very long texts are read whole, a batch at a time;
repeated rows are scored alike; without labels of both classes every score is the share
of 1, and 0.5 without any.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import (
    WORD_PATTERN,
    claim,
    map_batches,
    measured_bytes,
    scratch_table,
    small_side,
)
from tabscope.llm.toxicity import Logistic, held_out

#: Slices of the unlabelled documents, one a round.
ROUNDS = 3
#: A view hands on the documents it is this sure of, all of them.
SURE = 0.95
#: Every fourth labelled document calibrates, about so many at most.
CALIBRATION = 4
CALIBRATION_ROWS = 10_000
KEEP = 0.5
#: Columns that word shapes are hashed to.
SHAPES = 64
#: Weight of the common rate in a language's or source's log-odds, in documents.
PRIOR = 5.0
RIDGE = 1e-2
#: Sums of so many tasks the driver adds itself.
PARTS = 64
CACHE_WORDS = 400_000
_SLOTS = 1 << 20
_EDGE = re.compile(r"[^\W_]+")
_CLIP = 6.0


class _Shapes(dict):
    """Word to a bucket of its shape: kinds of letters, and whatever is no letter."""

    def __missing__(self, word: str) -> int:
        letters = "".join(_EDGE.findall(word))
        kind = "-"
        if letters:
            kind = "U" if letters.isupper() else "0" if letters.isdigit() else "a"
            kind += "+" if len(letters) > 12 else ""
        rest = _EDGE.sub("", word)
        self[word] = xxhash.xxh3_64_intdigest(f"{kind} {rest}".encode("utf-8", "surrogatepass")) % SHAPES
        return self[word]


_SHAPES = _Shapes()
TEXT_WIDTH = SHAPES + 6
META_WIDTH = 6


def text_view(text: str | None) -> np.ndarray:
    out = np.zeros(TEXT_WIDTH, np.float32)
    words = WORD_PATTERN.findall(text or "")
    n = len(words)
    if not n:
        return out
    claim(_SHAPES, _SHAPES.clear)
    if len(_SHAPES) > CACHE_WORDS:
        _SHAPES.clear()
    shapes = np.fromiter(map(_SHAPES.__getitem__, words), np.int64, n)
    out[:SHAPES] = np.sqrt(np.bincount(shapes, minlength=SHAPES) / n)
    size = len(text)
    out[SHAPES:] = (
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(words)) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(text.count, "#*$%&|<>!")) / size,
        np.log1p(size / n),
        np.log1p(n),
    )
    return out


def metadata_view(n_chars: int | None, lines: int) -> tuple[float, ...]:
    size = np.log1p(max(n_chars or 0, 0))
    a_line = np.log1p(max(n_chars or 0, 0) / (lines + 1))
    return n_chars is None, size, size**2, np.log1p(lines), a_line, a_line**2


_FEATURES = (
    "doc_id {0}, lang string, source string, label int, calibrates boolean, slice int,"
    " content binary, meta binary"
)


def features(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document with its features, label and slice, in the shared folder.

    Labels of the held-out quarter are never among them.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label"))
        .where("_id is not null and _label is not null")
        .groupBy("_id")
        .agg((F.min("_label") > 0).cast("int").alias("_label"))
        .where(~held_out(F.col("_id")))
    )
    place = F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(_SLOTS))
    known = known.withColumn("_calibrates", place % CALIBRATION == 0)
    rows = documents.select(
        "doc_id", F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), "text",
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    joined = rows.join(small_side(known, known.count(), 96), F.col("doc_id") == F.col("_id"), "left")
    dealt = F.pmod(F.xxhash64(F.lit(2), "doc_id", "n_chars"), F.lit(ROUNDS)).cast("int")
    chosen = joined.select(
        "doc_id", "lang", "source", F.col("_label").alias("label"),
        F.coalesce("_calibrates", F.lit(False)).alias("calibrates"), dealt.alias("slice"),
        "text", "n_chars",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes = (c.to_pylist() for c in batch.columns[6:])
            content = [text_view(t).tobytes() for t in texts]
            meta = [
                np.array(metadata_view(n, (t or "").count("\n")), np.float32).tobytes()
                for t, n in zip(texts, sizes, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(content, pa.binary()), pa.array(meta, pa.binary())],
                names=[*batch.schema.names[:6], "content", "meta"],
            )

    made = map_batches(chosen, run, _FEATURES.format(dict(rows.dtypes)["doc_id"]))
    return scratch_table(made, "cotraining-features")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float32).reshape(-1, width).astype(np.float64)


# Views ---------------------------------------------------------------------------------

_WIDTHS = (TEXT_WIDTH, META_WIDTH)
#: Per view and class: documents, weight, sums, sums of products.
_SIZES = [2 * (2 + d + d * d) for d in _WIDTHS]


def _logit(p: np.ndarray) -> np.ndarray:
    return np.clip(np.log((p + 1e-9) / (1 - p + 1e-9)), -_CLIP, _CLIP)


def moments(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The sums of a class: documents, weight, weighted sums and products."""
    w = x * weights[:, None]
    return np.concatenate([[(weights > 0).sum(), weights.sum()], w.sum(axis=0), (x.T @ w).ravel()])


@dataclass
class Discriminant:
    """A linear discriminant of two classes with one covariance, from sums."""

    weights: np.ndarray
    offset: float

    @classmethod
    def fit(cls, sums: np.ndarray, width: int) -> Discriminant:
        means, scatter, total = [], np.zeros((width, width)), 0.0
        for part in sums.reshape(2, -1):
            n, mean = part[1], part[2 : 2 + width] / max(part[1], 1e-9)
            scatter += part[2 + width :].reshape(width, width) - n * np.outer(mean, mean)
            means.append(mean)
            total += n
        spread = scatter / max(total, 1e-9)
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-8))
        shape = spread / np.outer(scale, scale) + RIDGE * np.eye(width)
        apart = np.linalg.solve(shape, (means[1] - means[0]) / scale) / scale
        # Sums of a few numbers in another order differ in the last digits only.
        weights = np.array([float(f"{w:.10e}") for w in apart])
        return cls(weights, -float(weights @ (means[0] + means[1])) / 2)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.offset


@dataclass
class Views:
    """Both views; ``platt`` calibrates each once it is known."""

    text: Discriminant
    meta: Discriminant
    platt: tuple[Logistic, Logistic] | None = None

    def raw(self, content: np.ndarray, meta: np.ndarray, odds: np.ndarray) -> list[np.ndarray]:
        limit = 50.0
        made = (self.text(content), self.meta(meta) + odds)
        return [np.clip(v, -limit, limit) for v in made]

    def __call__(self, *columns: np.ndarray) -> list[np.ndarray]:
        return [f(v[:, None]) for f, v in zip(self.platt, self.raw(*columns), strict=True)]


@dataclass
class Model:
    views: Views | None
    joint: Logistic | None
    share: float
    #: Log-odds by language and source, and pseudo-labels taken by the views each round.
    odds: DataFrame | None = None
    handed: tuple[tuple[int, int], ...] = ()


_GATHERED = "nr int, part binary, kind string, value string, w0 double, w1 double"


def gather(rows: DataFrame, views: Views | None) -> tuple[np.ndarray, DataFrame]:
    """Sums of both views over ``rows``, and (kind, value, w0, w1) of languages and sources.

    Without views each document counts for its label. With views a document counts for the
    class that the other view is sure of.
    """

    def weigh(p: np.ndarray) -> list[np.ndarray]:
        sure = 2 * p - 1
        return [np.where(1 - p >= SURE, -sure, 0.0), np.where(p >= SURE, sure, 0.0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((2, size // 2)) for size in _SIZES]
        groups: dict[tuple[str, str | None], np.ndarray] = defaultdict(lambda: np.zeros(2))
        for batch in batches:
            cell = dict(zip(batch.schema.names, batch.columns, strict=True))
            data = [_matrix(cell[c], d) for c, d in zip(("content", "meta"), _WIDTHS, strict=True)]
            if views is None:
                label = cell["label"].to_numpy(zero_copy_only=False)
                own = [(label == k).astype(np.float64) for k in (0, 1)]
                weights = [own, own]
            else:
                p = views(*data, cell["odds"].to_numpy(zero_copy_only=False))
                weights = [weigh(p[1]), weigh(p[0])]
            for sums, x, both in zip(total, data, weights, strict=True):
                for k in (0, 1):
                    sums[k] += moments(x, both[k])
            for kind in ("lang", "source"):
                for value, *w in zip(cell[kind].to_pylist(), *weights[1], strict=True):
                    if w[0] or w[1]:
                        groups[kind, value] += w
        nr = TaskContext.get().partitionId()
        part = np.concatenate([t.ravel() for t in total]).tobytes()
        found = sorted(groups.items(), key=repr)
        n = len(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([nr] * (n + 1), pa.int32()),
                pa.array([part, *[None] * n], pa.binary()),
                pa.array([None, *(k for (k, _), _ in found)], pa.string()),
                pa.array([None, *(v for (_, v), _ in found)], pa.string()),
                pa.array([None, *(w[0] for _, w in found)], pa.float64()),
                pa.array([None, *(w[1] for _, w in found)], pa.float64()),
            ],
            names=["nr", "part", "kind", "value", "w0", "w1"],
        )

    columns = ["content", "meta", "label", "lang", "source"]
    made = map_batches(rows.select(*columns, *(["odds"] if views else [])), run, _GATHERED)
    made = scratch_table(made, "cotraining-sums")
    groups = made.where("kind is not null").select("kind", "value", "w0", "w1")
    return _total(made.where("part is not null").select("nr", "part")), groups


def _total(parts: DataFrame) -> np.ndarray:
    """The parts added in the order of their tasks, on the executors first if they are many."""

    def add(rows: list[tuple[int, bytes]]) -> np.ndarray:
        out = np.zeros(sum(_SIZES))
        for _, part in sorted(rows):
            out += np.frombuffer(part)
        return out

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(rows)[0]], pa.int32()), pa.array([add(rows).tobytes()], pa.binary())],
                names=["nr", "part"],
            )

    tasks = parts.count()
    if tasks > PARTS:
        tasks = math.isqrt(tasks)
        dealt = parts.repartitionById(tasks, F.pmod("nr", F.lit(tasks)).cast("int"))
        parts = map_batches(dealt, some, "nr int, part binary")
    return add([(r.nr, r.part) for r in parts.collect()])


def log_odds(groups: DataFrame) -> DataFrame:
    """(kind, value, llr): how much a language or source speaks for class 1, drawn to 0."""
    sums = groups.groupBy("kind", "value").agg(
        F.round(F.sum("w0"), 6).alias("w0"), F.round(F.sum("w1"), 6).alias("w1")
    )
    sums = scratch_table(sums, "cotraining-groups")
    totals = sums.groupBy("kind").agg(
        F.sum("w0").alias("t0"), F.sum("w1").alias("t1"), F.count(F.lit(1)).alias("values")
    )
    rate = lambda k: (F.col(f"w{k}") + PRIOR * _common()) / (F.col(f"t{k}") + PRIOR)
    return sums.join(F.broadcast(totals), "kind").select(  # a row per kind
        "kind", "value", F.round(F.log(rate(1) / rate(0)), 9).alias("llr")
    )


def _common() -> Column:
    """A value's share of both classes, a little above 0."""
    return (F.col("w0") + F.col("w1") + 1) / (F.col("t0") + F.col("t1") + F.col("values"))


def with_odds(rows: DataFrame, odds: DataFrame) -> DataFrame:
    """``rows`` with the log-odds of their language and source added up; 0 if unknown."""
    width = measured_bytes(odds, "value")
    for kind in ("lang", "source"):
        mine = odds.where(F.col("kind") == kind).select(
            F.col("value").alias(f"_{kind}"), F.col("llr").alias(f"_{kind}_llr")
        )
        rows = rows.join(small_side(mine, 1, width), F.col(kind).eqNullSafe(F.col(f"_{kind}")), "left")
    total = F.coalesce("_lang_llr", F.lit(0.0)) + F.coalesce("_source_llr", F.lit(0.0))
    return rows.withColumn("odds", total).drop("_lang", "_source", "_lang_llr", "_source_llr")


def _calibrated(views: Views, rows: DataFrame) -> tuple[Views, np.ndarray, np.ndarray]:
    """The views calibrated, their raw logits on the calibration rows, and the labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [_matrix(c, d) for c, d in zip(batch.columns, _WIDTHS, strict=False)]
            raw = views.raw(*data, batch.column(2).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(v) for v in raw), batch.column(3)], names=["a", "b", "y"]
            )

    made = map_batches(rows.select("content", "meta", "odds", "label"), run, "a double, b double, y int")
    found = sorted(tuple(r) for r in made.limit(2 * CALIBRATION_ROWS).collect())
    table = np.array(found, np.float64).reshape(-1, 3)
    raw, y = table[:, :2], table[:, 2]
    views.platt = tuple(Logistic.fit(raw[:, [i]], y) for i in (0, 1))
    return views, raw, y


def train(rows: DataFrame) -> Model:
    """Co-training rounds over the feature rows; sums and a bounded sample reach the driver."""
    labelled = rows.where("label is not null")
    known = {
        r.calibrates: (r.n, r.good)
        for r in labelled.groupBy("calibrates")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good"))
        .collect()
    }
    n = sum(v[0] for v in known.values())
    share = sum(v[1] for v in known.values()) / n if n else 0.5
    if any(not 0 < known.get(part, (0, 0))[1] < known.get(part, (0, 0))[0] for part in (True, False)):
        return Model(None, None, share)
    drawn = int(_SLOTS * min(1.0, CALIBRATION_ROWS / known[True][0]))
    slot = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(_SLOTS))
    checks = labelled.where(F.col("calibrates") & (slot < drawn))
    sums, groups = gather(labelled.where("not calibrates"), None)
    handed = []

    def fitted() -> tuple[Views, DataFrame, np.ndarray, np.ndarray]:
        odds = scratch_table(log_odds(groups), "cotraining-odds")
        cut = np.split(sums, [_SIZES[0]])
        views = Views(*(Discriminant.fit(c, d) for c, d in zip(cut, _WIDTHS, strict=True)))
        views, raw, y = _calibrated(views, with_odds(checks, odds))
        return views, odds, raw, y

    views, odds, raw, y = fitted()
    for part in range(ROUNDS):
        fresh = rows.where(F.col("label").isNull() & (F.col("slice") == part))
        more, met = gather(with_odds(fresh, odds), views)
        sums, groups = sums + more, groups.unionAll(met)
        counts = [int(half.reshape(2, -1)[:, 0].sum()) for half in np.split(more, [_SIZES[0]])]
        handed.append(tuple(counts))
        views, odds, raw, y = fitted()
    both = np.column_stack([_logit(f(raw[:, [i]])) for i, f in enumerate(views.platt)])
    return Model(views, Logistic.fit(both, y), share, odds, tuple(handed))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Feature rows with the calibrated views and both combined."""
    names = ("text_score", "metadata_score", "score")
    if model.views is None:
        return rows.select("doc_id", *[F.lit(float(model.share)).alias(c) for c in names])
    views, joint = model.views, model.joint

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [_matrix(c, d) for c, d in zip(batch.columns[1:], _WIDTHS, strict=False)]
            p = views(*data, batch.column(3).to_numpy(zero_copy_only=False))
            p.append(joint(np.column_stack([_logit(v) for v in p])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v) for v in p)], names=["doc_id", *names]
            )

    kind = dict(rows.dtypes)["doc_id"]
    read = with_odds(rows, model.odds).select("doc_id", "content", "meta", "odds")
    return map_batches(read, run, f"doc_id {kind}, " + ", ".join(f"{c} double" for c in names))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, text_score, metadata_score, score (1: good) and kept of every row."""
    rows = features(documents, labels)
    return scored(rows, train(rows)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "text_score",
        "metadata_score",
        "score",
        (F.col("score") >= KEEP).alias("kept"),
    )
