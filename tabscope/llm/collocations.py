"""Collocations of two to four words, counted over a prefix-free parse.

A document is a sequence of words and breaks (between pieces no phrase crosses). A new
chunk starts where a window of three tokens hashes to 0 modulo :data:`PERIOD`, and ends
with the window that starts the next one, so that neighbours overlap by three tokens and
equal passages fall into equal chunks wherever they stand. Equal chunks are counted and
kept once: the dictionary. Phrases are counted inside distinct chunks, weighted by their
frequency in the parse. A phrase belongs to the chunk in which it starts before the last
three tokens; that region and the overlap hold every phrase of four words whole, and the
overlap itself counts in the next chunk only.

The dictionary is packed into blocks: words by number, a weight for each start. Counting
takes two steps, both exact:

1. Tasks send a hash and a count of each distinct phrase of a block; hashes are dealt by
   their upper bits and summed, and a block learns which of its hashes reach the least
   frequency. Words and pairs come first; longer phrases are sent only if all their pairs
   are frequent. A collision can only let a phrase through, never lose one.
2. What is left is spelled out per block and summed by its text.

No row stands for a group: every task holds a block, or a share of the hashes whose size
is counted beforehand, and a phrase that fills a third of the corpus is one hash a block.

Defined results: null languages are ``und``; null, empty and wordless texts add nothing;
repeated rows count each time; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import claim, map_batches, runs, scratch_table

LONGEST = 4
CONTEXT = LONGEST - 1
LEAST = 30
#: A longer phrase with this share (per cent) of a phrase's occurrences stands for it.
COVERED = 80
TOP = 2000
SCALE = 2_000_000
#: Mean number of tokens between triggers.
PERIOD = 64
#: Tokens of a block, and bytes of hashes one task sums.
BLOCK_TOKENS = 1 << 20
BUCKET_BYTES = 32 << 20
RUN_BYTES = 8 << 20
#: A worker forgets its word hashes beyond this many words.
CACHE_WORDS = 300_000
#: The ranking of a language is narrowed by so many tasks before one ranks what is left.
RANKERS = 16

_BREAK = b"."
_TO_TOKENS = bytes(
    ord(".") if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b"\t " else b for b in range(256)
)
_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _Hashes()


def tokens_of(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z lower-cased, and a full stop for each break between pieces."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only
    return data.translate(_TO_TOKENS).replace(_BREAK, b" . ").split(b" ")


def chunks_of(text: str | None, period: int = PERIOD) -> list[bytes]:
    """The prefix-free parse of a text; each chunk ends with CONTEXT tokens of overlap."""
    tokens = [t for t in tokens_of(text) if t]
    if not tokens:
        return []
    claim(_HASHES, _HASHES.clear)
    if len(_HASHES) > CACHE_WORDS:
        _HASHES.clear()
    n = len(tokens)
    tokens += [_BREAK] * CONTEXT
    h = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, n + CONTEXT)
    window = h[:n] * _ODD[0] + h[1 : n + 1] * _ODD[1] + h[2 : n + 2] * _ODD[2]
    triggers = np.flatnonzero((window >> np.uint64(33)) % np.uint64(period) == 0)
    cuts = [0, *triggers[triggers > 0].tolist(), n]
    return [b" ".join(tokens[a : b + CONTEXT]) for a, b in zip(cuts, cuts[1:], strict=False)]


def dictionary(documents: DataFrame) -> DataFrame:
    """(lang, chunk, n): the distinct chunks of each language and their parse frequency."""
    period = PERIOD

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, RUN_BYTES):
            found: Counter[tuple[str, bytes]] = Counter()
            for lang, text in zip(*(c.to_pylist() for c in run.columns), strict=True):
                found.update((lang, chunk) for chunk in chunks_of(text, period))
            langs, chunks = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(chunks, pa.binary()), pa.array(found.values(), pa.int64())],
                names=["lang", "chunk", "n"],
            )

    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    parsed = map_batches(rows, parse, "lang string, chunk binary, n long")
    return parsed.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


# Blocks --------------------------------------------------------------------------------

_BLOCK = "block long, lang string, words binary, ids binary, lengths binary, weights binary, tokens long, total long"


@dataclass
class Block:
    """Word numbers (0: a break) and, for each place, how often a phrase starts there."""

    lang: str
    words: list[bytes]
    ids: np.ndarray
    weights: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        lengths = np.frombuffer(row["lengths"], np.int32)
        weights = np.frombuffer(row["weights"], np.int64)
        ids = np.frombuffer(row["ids"], np.int32)
        return cls(row["lang"], row["words"].split(b" "), ids, np.repeat(weights, lengths))

    def row(self, number: int) -> tuple:
        """Weights are stored by runs."""
        edges = np.flatnonzero(np.diff(self.weights, prepend=self.weights[:1] - 1))
        lengths = np.diff(edges, append=len(self.weights)).astype(np.int32)
        return (
            number,
            self.lang,
            b" ".join(self.words),
            self.ids.astype(np.int32).tobytes(),
            lengths.tobytes(),
            self.weights[edges].tobytes(),
            len(self.ids),
            int(self.weights[self.ids > 0].sum()),
        )

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all phrases of a length, and their hashes.

        Pairs also where they have no weight: a longer phrase may end in an overlap, and
        its block has to learn of the pairs there as well.
        """
        # Word 0 is the break's place in ``words``: numbers of words start at 1.
        seed = xxhash.xxh3_64_intdigest(self.lang.encode())
        own = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.words), np.uint64)
        h = own[self.ids]
        n = max(0, len(self.ids) - length + 1)
        word = self.ids > 0
        ok = (self.weights[:n] > 0) | (length == 2)
        key = np.zeros(n, np.uint64)
        for i in range(length):
            ok = ok & word[i : i + n]
            key = key * _ODD[0] + h[i : i + n]
            key = (key ^ (key >> np.uint64(32))) * _ODD[1]
        at = np.flatnonzero(ok)
        key = key[at]
        return at, (key ^ (key >> np.uint64(29))).view(np.int64)


class _Builder:
    """Collects the chunks of one language into a block."""

    def __init__(self, lang: str) -> None:
        self.lang = lang
        self.number: defaultdict[bytes, int] = defaultdict(count(1).__next__, {_BREAK: 0})
        self.ids: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.size = 0

    def add(self, chunk: bytes, n: int) -> None:
        tokens = chunk.split(b" ")
        # A break between chunks keeps phrases inside.
        ids = np.zeros(len(tokens) + 1, np.int32)
        ids[:-1] = [self.number[t] for t in tokens]
        weights = np.full(len(ids), n, np.int64)
        weights[-1 - CONTEXT :] = 0
        self.ids.append(ids)
        self.weights.append(weights)
        self.size += len(ids)

    def block(self) -> Block:
        return Block(self.lang, list(self.number), np.concatenate(self.ids), np.concatenate(self.weights))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_BLOCK_FIELDS = [
    ("block", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("ids", pa.binary()),
    ("lengths", pa.binary()), ("weights", pa.binary()), ("tokens", pa.int64()), ("total", pa.int64()),
]


def packed(chunks: DataFrame) -> DataFrame:
    """The dictionary as blocks, written to the shared folder."""
    size, schema = BLOCK_TOKENS, pa.schema(_BLOCK_FIELDS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        open_: dict[str, _Builder] = {}
        for batch in batches:
            for lang, chunk, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                builder = open_.get(lang) or open_.setdefault(lang, _Builder(lang))
                builder.add(chunk, n)
                if builder.size >= size:
                    yield _batch([open_.pop(lang).block().row(next(numbers))], schema)
        for builder in open_.values():
            yield _batch([builder.block().row(next(numbers))], schema)

    return scratch_table(map_batches(chunks, pack, _BLOCK), "collocations-blocks")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


# Counting ------------------------------------------------------------------------------


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[edges], np.add.reduceat(counts[order], edges) if len(keys) else counts


def frequent(blocks: DataFrame, lengths: tuple[int, ...], least: int) -> DataFrame:
    """(block, found): for each block those of its phrases' hashes that reach ``least``."""
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(1, -(-tokens * len(lengths) * 12 // BUCKET_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block.read(row)
            keys, counts = [], []
            for length in lengths:
                at, key = block.phrases(length)
                found = _summed(key, block.weights[at])
                keys.append(found[0])
                counts.append(found[1])
            key, n = _summed(np.concatenate(keys), np.concatenate(counts))
            if not len(key):
                continue
            # The upper bits say where a hash is summed; signed order runs along with them.
            upper = (key >> 32) + (1 << 31)
            place = upper * buckets >> 32
            numbers, first = np.unique(place, return_index=True)
            ends = [*first[1:], len(key)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(numbers), row["block"], np.int64)),
                    pa.array(numbers.astype(np.int32)),
                    pa.array([key[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                    pa.array([n[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                ],
                names=["block", "bucket", "keys", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, keys, counts = [], [], []
        for batch in batches:
            owner += batch.column(0).to_pylist()
            keys += [np.frombuffer(k, np.int64) for k in batch.column(2).to_pylist()]
            counts += [np.frombuffer(c, np.int64) for c in batch.column(3).to_pylist()]
        if not owner:
            return
        key, n = _summed(np.concatenate(keys), np.concatenate(counts))
        key = key[n >= least]
        kept = [(b, _inside(k, key)) for b, k in zip(owner, keys, strict=True)]
        kept = [(b, k[hit].tobytes()) for (b, hit), k in zip(kept, keys, strict=True) if hit.any()]
        yield _batch(kept, pa.schema([("block", pa.int64()), ("keys", pa.binary())]))

    rows = blocks.select("block", "lang", "words", "ids", "lengths", "weights")
    sent = map_batches(rows, send, "block long, bucket int, keys binary, counts binary")
    dealt = sent.repartitionById(buckets, F.col("bucket"))
    replies = map_batches(dealt, add, "block long, keys binary")
    return replies.groupBy("block").agg(F.collect_list("keys").alias("found"))


def _inside(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which keys stand in the ordered ones."""
    if not len(ordered):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return ordered[at] == keys


def _spelled(block: Block, length: int, known: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """(lang, phrase, count) of a block's frequent phrases, and where they start."""
    at, key = block.phrases(length)
    hit = _inside(key, known)
    at, key = at[hit], key[hit]
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    edges = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(at) else order
    total = np.add.reduceat(block.weights[at][order], edges) if len(at) else order
    columns = [block.ids[at[order[edges]] + i].tolist() for i in range(length)]
    words = block.words
    # A collision inside a block would give one text the counts of two: spell those apart.
    same = np.ones(len(edges), bool)
    for i in range(length):
        value = block.ids[at[order] + i]
        first = np.repeat(value[edges], np.diff(edges, append=len(at)))
        odd = np.flatnonzero(value != first)
        if len(odd):
            same[np.unique(np.searchsorted(edges, odd, "right") - 1)] = False
    out = [
        (block.lang, b" ".join([words[i] for i in ids]), n)
        for *ids, n, one in zip(*columns, total.tolist(), same.tolist(), strict=True)
        if one and n
    ]
    for group in np.flatnonzero(~same):
        end = edges[group + 1] if group + 1 < len(edges) else len(at)
        apart: Counter[bytes] = Counter()
        for place in at[order[edges[group] : end]]:
            phrase = b" ".join(words[i] for i in block.ids[place : place + length])
            apart[phrase] += int(block.weights[place])
        out += [(block.lang, phrase, n) for phrase, n in apart.items() if n]
    return out, at


def _longer_only(block: Block, pairs: np.ndarray) -> Block | None:
    """The stretches of a block in which two or more frequent pairs follow each other."""
    pair = np.zeros(len(block.ids) + CONTEXT, bool)
    pair[pairs] = True
    n = len(block.ids)
    start = pair[:n] & pair[1 : n + 1]
    keep = start.copy()
    keep[1:] |= start[:-1]
    keep[2:] |= start[:-2]
    # Phrases of four words need the third pair as well; its last word stays with it.
    keep[3:] |= start[:-3] & pair[2 : n - 1]
    if not keep.any():
        return None
    ids = np.where(keep, block.ids, 0)
    weights = np.where(start, block.weights, 0)
    stay = keep.copy()
    stay[1:] |= keep[:-1]  # one break after each stretch
    ids, weights = ids[stay], weights[stay]
    used, ids = np.unique(ids, return_inverse=True)
    words = [block.words[i] for i in used]
    if used[0] != 0:
        words, ids = [_BREAK, *words], ids + 1
    return Block(block.lang, words, ids.astype(np.int32), weights)


_PHRASE = "lang string, phrase string, n long"


def counted(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to 4 words with f >= least, and (lang, n)."""
    blocks = packed(dictionary(documents))
    schema = pa.schema([("p_lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64()), *_BLOCK_FIELDS])
    blank_block, blank_phrase = (None,) * len(_BLOCK_FIELDS), (None,) * 3

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Frequent words and pairs spelled out; the stretches that may hold more."""
        for row in _rows(batches):
            block, known = Block.read(row), np.sort(np.frombuffer(b"".join(row["found"]), np.int64))
            pairs, at = _spelled(block, 2, known)
            rest = _longer_only(block, at)
            rows = [(*p, *blank_block) for p in _spelled(block, 1, known)[0] + pairs]
            if rest is not None:
                rows.append((*blank_phrase, *rest.row(row["block"])))
            for at_ in range(0, len(rows), 1 << 16):
                yield _batch(rows[at_ : at_ + (1 << 16)], schema)

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block, known = Block.read(row), np.sort(np.frombuffer(b"".join(row["found"]), np.int64))
            out = [p for length in range(3, LONGEST + 1) for p in _spelled(block, length, known)[0]]
            yield _batch(out, pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())]))

    columns = ["block", "lang", "words", "ids", "lengths", "weights"]
    first = blocks.select(*columns).join(frequent(blocks, (1, 2), least), "block")
    mixed = scratch_table(
        map_batches(first, short, f"p_lang string, phrase binary, n long, {_BLOCK}"), "collocations-pairs"
    )
    rest = mixed.where("block is not null").select(*(name for name, _ in _BLOCK_FIELDS))
    second = rest.select(*columns).join(frequent(rest, tuple(range(3, LONGEST + 1)), least), "block")
    spelled = mixed.where("phrase is not null").select(
        F.col("p_lang").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "n"
    )
    every = spelled.unionAll(map_batches(second, long, _PHRASE))
    phrases = (
        every.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    )
    totals = blocks.groupBy("lang").agg(F.sum("total").alias("n"))
    return scratch_table(phrases, "collocations-phrases"), totals


# Scores --------------------------------------------------------------------------------


def _part(start: str, length: str) -> Column:
    return F.expr(f"array_join(slice(words, {start}, {length}), ' ')")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one stands for."""
    words = phrases.withColumn("words", F.split("phrase", " "))
    candidates = words.withColumn("size", F.size("words")).where("size > 1")
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "k",
        _part("1", "k").alias("left"),
        _part("k + 1", "size - k").alias("right"),
    )
    known = phrases.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), "f")
    of = lambda side: (F.col("lang") == F.col("p_lang")) & (F.col(side) == F.col("part"))
    sized = (
        cuts.join(known.withColumnRenamed("f", "l"), of("left"))
        .drop("p_lang", "part", "left")
        .join(known.withColumnRenamed("f", "r"), of("right"))
        .drop("p_lang", "part", "right")
    )
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    score = F.expr(f"cast({SCALE} * cast(a as decimal(27,0)) div (cast(l as decimal(19,0)) + r) as long)")
    best = (
        sized.withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = (
        candidates.where("size > 2")
        .withColumn("length", F.explode(F.expr("sequence(2, size - 1)")))
        .withColumn("start", F.explode(F.expr("sequence(1, size - length + 1)")))
        .select(F.col("lang").alias("p_lang"), _part("start", "length").alias("part"), "f")
        .groupBy("p_lang", "part")
        .agg(F.max("f").alias("longer"))
    )
    stands = F.coalesce(100 * wide("longer") >= COVERED * wide("a"), F.lit(False))
    return best.join(inner, of("phrase"), "left").where(~stands).drop("p_lang", "part", "longer")


def ranked(scores: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each language; several tasks narrow a large one down."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = Window.partitionBy("lang", "salt").orderBy(*order)
    every = Window.partitionBy("lang").orderBy(*order)
    return (
        scores.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANKERS)))
        .withColumn("rank", F.row_number().over(some))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(every).cast("long"))
        .where(F.col("rank") <= top)
        .drop("salt")
    )


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best collocations."""
    phrases, totals = counted(documents, least)
    best = ranked(scored(phrases), top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
