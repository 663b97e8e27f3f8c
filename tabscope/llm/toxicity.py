"""Toxicity from class-conditional Kneser-Ney models of word pairs.

Two models, one per label, give every word a probability given the word before it. A pair
that a class has seen keeps its discounted count; what the discount frees goes to the word
alone, whose discounted count backs off to its stem (its first four letters). A stem's
probability is Kneser-Ney's: the number of different words of the class that continue it,
not how often they occur. Both classes share the weights of all backoffs and the
distribution below the stems, so an expression that is rare or unseen says little or
nothing, however different the classes are in size.

All counts are exact and cover every labelled document that is learned from; the tables
grow with the corpus. What workers score with are log-likelihood ratios: of the words and
pairs whose ratio differs from the one they would back off to by more than a stated gain
over all their occurrences (entropy pruning), and of stems for all others.

A document is judged by the ratio of the two models, normalised by length: over all its
words, and over its most telling words, where a few insults in a long text still show. A
logistic fit over labelled documents that are not counted turns these into a score.

Defined results: a null or empty text, or one without letters, has no words; all its
ratios are 0 and its score is the model's answer to that. A document labelled several
times takes its highest label; null labels and labels of unknown documents count for
nothing. Repeated rows are scored alike. Without labelled documents every score is 0;
with one class only, every score is that class's share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.llm.common import (
    appended,
    claim,
    keeping_names,
    map_batches,
    parquet_columns,
    scratch_path,
    scratch_table,
    small_side,
)

STEM_LETTERS = 4
DISCOUNT = 0.75
#: Log-likelihood a word or pair must gain over its backoff, in nats over all occurrences.
WORD_GAIN = 1.0
PAIR_GAIN = 8.0
#: A pair seen less often can not gain that much.
LEAST_PAIRS = 3
#: One labelled document in so many is not counted: the logistic fit sees it.
FIT_FOLD = 5
#: The logistic fit sees about this many labelled documents, drawn by hash of their id.
FIT_ROWS = 20_000
THRESHOLD = 0.3
#: Words counted at a time, and bytes of pairs one task sums.
RUN_WORDS = 1_000_000
BUCKET_BYTES = 16 << 20
#: Characters of the texts whose words are worked on at once.
RUN_CHARACTERS = 1 << 20
#: Words of more bytes are hashed alone.
LONG_WORD = 256
#: First bits of its keys that a table of ratios knows, at most.
MOST_BITS = 24

_SLOTS = 1 << 20
TOP = 2
_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
#: What is no letter or digit beyond ASCII, and whether a byte of the remaining text is one.
_OTHER = re.compile(r"[^\x00-\x7F\w]+")
_IN_WORD = np.array([b > 0x7F or chr(b).isalnum() for b in range(0x100)])
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _hashes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the ``sizes`` bytes from ``starts`` on; at least seven more follow them."""
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = sizes.astype(np.uint64) * _ODD[0]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    which = np.flatnonzero(sizes <= LONG_WORD)
    done = 0
    while len(which):
        left = sizes[which] - done
        h = (out[which] ^ (eights[starts[which] + done] & _FIRST_BYTES[np.minimum(left, 8)])) * _ODD[0]
        h = (h ^ (h >> np.uint64(32))) * _ODD[1]
        out[which] = h ^ (h >> np.uint64(29))
        done += 8
        which = which[left > 8]
    return out


def _hash(word: str) -> int:
    """The hash of one word."""
    data = word.encode("utf-8", "surrogatepass")
    return int(_hashes(data + bytes(8), np.zeros(1, np.int64), np.array([len(data)]))[0])


def _stems(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes of the first letters of the words at ``starts``."""
    leads = np.flatnonzero(data & 0xC0 != 0x80)
    if len(leads) == len(data):
        return np.minimum(sizes, STEM_LETTERS)
    after = np.searchsorted(leads, starts) + STEM_LETTERS
    return np.minimum(sizes, np.append(leads, [len(data)] * STEM_LETTERS)[after] - starts)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(words, 2): the hashes of the words of the texts and of their stems, in order; and
    where each text's begin and the last one's end."""
    claim(_loaded, _loaded.cache_clear)
    lower = [(t or "").lower() for t in texts]
    parts = [(t if t.isascii() else _OTHER.sub(" ", t)).encode("utf-8", "surrogatepass") for t in lower]
    joined = b" ".join([b"", *parts, bytes(8)])
    data = np.frombuffer(joined, np.uint8)
    inside = _IN_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    found = np.empty((len(starts), 2), np.uint64)
    found[:, 0] = _hashes(joined, starts, sizes)
    found[:, 1] = _hashes(joined, starts, _stems(data, starts, sizes))
    return found, np.searchsorted(starts, np.cumsum([0, *[len(part) + 1 for part in parts]]))


def _keys(text: str | None) -> np.ndarray:
    """The hashes of the words of one text."""
    return _words([text])[0]


def _in_runs(texts: list[str | None]) -> Iterator[slice]:
    """The places of ``texts``, RUN_CHARACTERS at once."""
    at = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= RUN_CHARACTERS or i + 1 == len(texts):
            yield slice(at, i + 1)
            at, held = i + 1, 0


def _pairs(words: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
    """The hash of each word with the one before it; 0 for the first of a text."""
    out = np.zeros(len(words), np.uint64)
    if len(words) > 1:
        key = words[:-1] * _ODD[0] + words[1:]
        key = (key ^ (key >> np.uint64(32))) * _ODD[1]
        out[1:] = key ^ (key >> np.uint64(29))
    if bounds is not None:
        out[bounds[bounds < len(out)]] = 0
    return out


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; a null id has no label to learn."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """(_id, _label) outside the held-out quarter, one row per document."""
    return (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_label"))
        .where("_id is not null and _label is not null")
        .groupBy("_id")
        .agg((F.max("_label") > 0).cast("int").alias("_label"))
        .where(~held_out(F.col("_id")))
    )


def labelled(documents: DataFrame, known: DataFrame, rows: int) -> DataFrame:
    """(text, label) of the documents that the ``rows`` labels of ``known`` belong to."""
    texts = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    return texts.join(small_side(known, rows, 96), "_id").select("_text", "_label")


# Counting ------------------------------------------------------------------------------

_PACKED = "bucket int, kind int, a binary, b binary, c0 binary, c1 binary"
_SUMMED = "kind int, a long, b long, c0 long, c1 long, n0 long, n1 long"
_WORDS, _PAIRS, _CONTEXTS = range(3)


def _summed(key: np.ndarray, c0: np.ndarray, c1: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of the distinct keys, and the sums of both counts for each."""
    if not len(key):
        return np.empty(0, np.int64), c0, c1
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return order[edges], np.add.reduceat(c0[order], edges), np.add.reduceat(c1[order], edges)


def _sender(buckets: int):
    """Counts of the words and pairs of a task, packed by the bucket that sums them."""

    def packed(kind: int, key: np.ndarray, a: np.ndarray, b: np.ndarray, label: np.ndarray):
        if not len(key):
            return
        at, c0, c1 = _summed(key, 1 - label, label)
        place = (key[at] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        first = np.flatnonzero(np.diff(place, prepend=place[:1] + np.uint64(1)))
        ends = [*first[1:], len(place)]
        cut = lambda x: [x[i:j].tobytes() for i, j in zip(first, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(place[first].astype(np.int32)),
                pa.array(np.full(len(first), kind, np.int32)),
                *[pa.array(cut(x), pa.binary()) for x in (a[at], b[at], c0, c1)],
            ],
            names=["bucket", "kind", "a", "b", "c0", "c1"],
        )

    def flush(words: list[np.ndarray], labels: list[np.ndarray], pairs: list[np.ndarray]):
        word, stem = np.concatenate(words).T
        label, pair = np.concatenate(labels), np.concatenate(pairs)
        yield from packed(_WORDS, word, word, stem, label)
        second = np.flatnonzero(pair)
        yield from packed(_PAIRS, pair[second], word[second - 1], word[second], label[second])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, labels, pairs, size = [], [], [], 0
        for batch in batches:
            texts, marks = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for run in _in_runs(texts):
                found, bounds = _words(texts[run])
                words.append(found)
                labels.append(np.repeat(marks[run].astype(np.int64), np.diff(bounds)))
                pairs.append(_pairs(found[:, 0], bounds))
                size += len(found)
            if size > RUN_WORDS:
                yield from flush(words, labels, pairs)
                words, labels, pairs, size = [], [], [], 0
        if size:
            yield from flush(words, labels, pairs)

    return send


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, frequent pairs, and what each word's pairs add up to as a context."""
    held: dict[int, list[list[np.ndarray]]] = {_WORDS: [[], [], [], []], _PAIRS: [[], [], [], []]}
    for batch in batches:
        for kind, *columns in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
            for parts, data in zip(held[kind], columns, strict=True):
                parts.append(np.frombuffer(data, np.int64))

    def rows(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
        n = len(columns[0])
        every = [np.full(n, kind, np.int32), *columns, *[np.zeros(n, np.int64)] * (6 - len(columns))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in every], names=["kind", "a", "b", "c0", "c1", "n0", "n1"]
        )

    for kind, parts in held.items():
        if not parts[0]:
            continue
        a, b, c0, c1 = (np.concatenate(p) for p in parts)
        key = a.view(np.uint64) * _ODD[0] + b.view(np.uint64)
        at, c0, c1 = _summed(key, c0, c1)
        a, b = a[at], b[at]
        if kind == _WORDS:
            yield rows(_WORDS, a, b, c0, c1)
            continue
        enough = c0 + c1 >= LEAST_PAIRS
        yield rows(_PAIRS, a[enough], b[enough], c0[enough], c1[enough])
        first, n0, n1 = _summed(a, (c0 > 0).astype(np.int64), (c1 > 0).astype(np.int64))
        _, t0, t1 = _summed(a, c0, c1)
        yield rows(_CONTEXTS, a[first], np.zeros(len(first), np.int64), t0, t1, n0, n1)


def counted(rows: DataFrame) -> DataFrame:
    """Counts of ``rows(text, label)`` in the shared folder: words, pairs, contexts."""
    size = rows.agg(F.sum(F.octet_length(rows.columns[0]))).first()[0] or 0
    # Some six bytes of text a word, and eighteen for what is sent of it.
    buckets = max(1, -(-3 * size // BUCKET_BYTES))
    sent = map_batches(rows, _sender(buckets), _PACKED)
    summed = map_batches(sent.repartitionById(buckets, F.col("bucket")), _add, _SUMMED)
    return scratch_table(summed, "toxicity-counts")


# Models --------------------------------------------------------------------------------


def _ratio(one: Column, zero: Column) -> Column:
    return F.log(one / zero)


def ratios(counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(key, ratio) of stems, words and pairs that tell more than their backoff.

    None if one of the classes has no words.
    """
    words = counts.where(F.col("kind") == _WORDS).groupBy("a", "b").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1")
    )
    words = scratch_table(words, "toxicity-words")
    stems = words.groupBy("b").agg(
        F.count_if(F.col("c0") > 0).alias("k0"),
        F.count_if(F.col("c1") > 0).alias("k1"),
        F.sum(F.col("c0") + F.col("c1")).alias("tokens"),
    )
    t = words.agg(F.sum("c0").alias("t0"), F.sum("c1").alias("t1")).first()
    if not t.t0 or not t.t1:
        return None
    k = stems.agg(
        F.sum("k0").alias("k0"),
        F.sum("k1").alias("k1"),
        F.count_if(F.col("k0") > 0).alias("s0"),
        F.count_if(F.col("k1") > 0).alias("s1"),
        F.count(F.lit(1)).alias("stems"),
    ).first()
    types = (k.k0, k.k1)
    below = DISCOUNT * (k.s0 + k.s1) / (k.k0 + k.k1)
    shared = (F.col("k0") + F.col("k1") + 1) / (k.k0 + k.k1 + k.stems + 1)
    stem = lambda c: F.greatest(F.col(f"k{c}") - DISCOUNT, F.lit(0.0)) / types[c] + below * shared
    stems = scratch_table(
        stems.select("b", "tokens", *[stem(c).alias(f"q{c}") for c in (0, 1)]), "toxicity-stems"
    )

    freed = DISCOUNT * (k.k0 + k.k1) / (t.t0 + t.t1)
    within = (F.col("c0") + F.col("c1") + 0.5) / (F.col("tokens") + 1)
    tokens = (t.t0, t.t1)
    word = lambda c: (
        F.greatest(F.col(f"c{c}") - DISCOUNT, F.lit(0.0)) / tokens[c]
        + freed * F.col(f"q{c}") * within
    )
    single = scratch_table(
        words.join(stems, "b").select(
            F.col("a").alias("word"),
            (F.col("c0") + F.col("c1")).alias("n"),
            word(0).alias("p0"),
            word(1).alias("p1"),
            _ratio(F.col("q1"), F.col("q0")).alias("backoff"),
        ),
        "toxicity-single",
    )
    alone = _ratio(F.col("p1"), F.col("p0"))

    contexts = counts.where(F.col("kind") == _CONTEXTS).groupBy("a").agg(
        *[F.sum(c).alias(f"u{c}") for c in ("c0", "c1", "n0", "n1")]
    )
    weight = DISCOUNT * (F.col("un0") + F.col("un1")) / (F.col("uc0") + F.col("uc1"))
    pair = lambda c: F.when(F.col(f"uc{c}") == 0, F.col(f"p{c}")).otherwise(
        F.greatest(F.col(f"c{c}") - DISCOUNT, F.lit(0.0)) / F.col(f"uc{c}")
        + weight * F.col(f"p{c}")
    )
    pairs = (
        counts.where(F.col("kind") == _PAIRS)
        .select("a", F.col("b").alias("word"), "c0", "c1")
        .join(contexts, "a")
        .join(single.select("word", "p0", "p1"), "word")
        .select(
            "a", "word", (F.col("c0") + F.col("c1")).alias("n"), alone.alias("backoff"),
            _ratio(pair(1), pair(0)).alias("ratio"),
        )
    )

    gains = lambda least: F.col("n") * F.abs(F.col("ratio") - F.col("backoff")) >= least
    return (
        stems.select(F.col("b").alias("key"), _ratio(F.col("q1"), F.col("q0")).alias("ratio")),
        single.select(F.col("word").alias("key"), alone.alias("ratio"), "n", "backoff")
        .where(gains(WORD_GAIN))
        .select("key", "ratio"),
        pairs.where(gains(PAIR_GAIN)).select("a", "word", "ratio"),
    )


@dataclass
class Table:
    """Ratios by key; what is not in it takes another's ratio."""

    keys: np.ndarray
    ratios: np.ndarray

    def __post_init__(self) -> None:
        # Most keys looked for are not there, which their first bits tell.
        bits = min(max(8 * len(self.keys), 2).bit_length(), MOST_BITS)
        self.shift = np.uint64(64 - bits)
        self.begins = np.zeros(1 << bits, bool)
        self.begins[self.keys >> self.shift] = True

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        order = np.argsort(keys)
        return cls(keys[order], values[order].astype(np.float64))

    def __call__(self, keys: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        out = otherwise.copy()
        maybe = np.flatnonzero(self.begins[keys >> self.shift])
        if len(maybe):
            some = keys[maybe]
            at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            there = self.keys[at] == some
            out[maybe[there]] = self.ratios[at[there]]
        return out


@dataclass
class Ratios:
    """What a worker scores with."""

    stems: Table
    words: Table
    pairs: Table

    def __call__(self, keys: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        """Log-likelihood ratio of each word of one text or several, given the one before."""
        words, at, places = np.unique(keys[:, 0], return_index=True, return_inverse=True)
        single = self.words(words, self.stems(keys[at, 1], np.zeros(len(at))))
        return self.pairs(_pairs(keys[:, 0], bounds), single[places])

    def of_texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ratios of the words of each text."""
        for run in _in_runs(texts):
            keys, bounds = _words(texts[run])
            yield from np.split(self(keys, bounds), bounds[1:-1])


@lru_cache(maxsize=1)
def _loaded(stored: tuple[str, ...]) -> Ratios:
    """The ratios, as a worker reads them from the shared folder."""
    stems, words, pairs = (parquet_columns(uri) for uri in stored)
    unsigned = lambda c: c.astype(np.int64).view(np.uint64)
    first, second, ratio = pairs
    both = _pairs(np.column_stack([unsigned(first), unsigned(second)]).ravel())[1::2]
    return Ratios(
        Table.of(unsigned(stems[0]), stems[1]),
        Table.of(unsigned(words[0]), words[1]),
        Table.of(both, ratio),
    )


def features(ratios: np.ndarray) -> list[float]:
    """Length-normalised ratio of all words, and of the most telling one and two words."""
    n = len(ratios)
    if not n:
        return [0.0] * 4
    top = np.sort(np.partition(ratios, n - TOP)[n - TOP :] if n > TOP else ratios)[::-1]
    return [float(ratios.mean()), float(top[0]), float(top.mean()), float(np.log1p(n))]


@dataclass
class Logistic:
    """Logistic regression by Newton steps on standardised columns."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> Logistic:
        center, scale = x.mean(0), x.std(0) + 1e-9
        z = np.c_[(x - center) / scale, np.ones(len(x))]
        w = np.zeros(z.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            step = np.linalg.solve(hessian, z.T @ (p - y) + ridge * w)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return cls(center, scale, w)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[(x - self.center) / self.scale, np.ones(len(x))]
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


@dataclass
class Model:
    stored: tuple[str, ...] | None
    fit: Logistic | None
    share: float


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Counts over the labelled documents outside the held-out quarter, then the fit.

    Only the features of FIT_ROWS documents reach the driver, of documents that are not
    counted; where those lack a class, of counted ones.
    """
    known = training_labels(labels)
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("_label"), F.lit(0))).first()
    if not 0 < toxic < n:
        return Model(None, None, toxic / n if n else 0.0)
    fold = F.pmod(F.xxhash64(F.lit(FIT_FOLD), F.col("_id")), F.lit(FIT_FOLD)) == 0
    learned = ratios(counted(labelled(documents, known.where(~fold), n)))
    if learned is None:
        return Model(None, None, toxic / n)
    stored = tuple(
        scratch_path(t, f"toxicity-{name}-ratios")
        for t, name in zip(learned, ("stem", "word", "pair"), strict=True)
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _loaded(stored)
        for batch in batches:
            texts, marks = (c.to_pylist() for c in batch.columns)
            out = [[*features(r), mark] for r, mark in zip(found.of_texts(texts), marks, strict=True)]
            columns = [pa.array(list(c), pa.float64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["f0", "f1", "f2", "f3", "y"])

    def seen(some: DataFrame, share: float) -> np.ndarray:
        drawn = some.where(F.pmod(F.xxhash64("_id"), F.lit(_SLOTS)) < int(_SLOTS * min(1.0, share)))
        sample = labelled(documents, drawn, min(n, 2 * FIT_ROWS))
        frame = map_batches(sample, measured, "f0 double, f1 double, f2 double, f3 double, y double")
        rows = sorted(tuple(r) for r in frame.limit(2 * FIT_ROWS).collect())
        return np.array(rows, np.float64).reshape(-1, 5)

    rows = seen(known.where(fold), FIT_FOLD * FIT_ROWS / n)
    if not 0 < rows[:, 4].sum() < len(rows):
        rows = seen(known, FIT_ROWS / n)
    both = 0 < rows[:, 4].sum() < len(rows)
    return Model(stored, Logistic.fit(rows[:, :4], rows[:, 4]) if both else None, toxic / n)


def with_scores(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``documents`` with a double column ``name``; reads the column ``text`` only."""
    stored, fit, share = model.stored, model.fit, model.share

    if fit is None:
        return documents.withColumn(name, F.lit(float(share)))

    def score(texts: pa.Array) -> list:
        found = _loaded(stored)
        rows = np.array([features(r) for r in found.of_texts(texts.to_pylist())])
        return [fit(rows) if len(rows) else np.empty(0)]

    return appended(documents, ["text"], score, [T.StructField(name, T.DoubleType())])


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(documents, labels)
    scored = with_scores(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@keeping_names
def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not judged toxic, all columns as they were."""
    model = train(documents, labels)
    scored = with_scores(documents, model, "_tabscope_toxicity")
    return scored.where(F.col("_tabscope_toxicity") < THRESHOLD).drop("_tabscope_toxicity")
