"""Benchmark passages in documents, also re-parameterised ones, by template windows.

A text becomes a template: numbers, names and units turn into typed placeholders, all
other words are lower-cased. Windows of five template tokens that hold at least three
plain words are hashed. A document holds an item if at least 0.8 of the item's windows
occur in it with consistent slots, and 0.8 of the slots they cover are consistent: along
one alignment of the two texts, a value that fills a slot of the item always stands for
the same value of the document, and the other way round. A question that counts 9 apples,
9 pears and 9 plums is found with 4 of each, and not with 4, 5 and 6.

Tasks drop windows that a Bloom filter of the benchmark's windows rules out; its size is
capped, and the hash join that follows removes what it lets through by mistake. An item
is searched by its rarest windows first: of n windows, any n - ceil(0.8 n) + 1 include
one that a contaminated document must share, so boilerplate of many items pairs nothing.

A capitalised word is a name wherever it stands, so that a name that opens a sentence can
change, and what a window looks like does not depend on the text around it.

An item without any window of three plain words (sums, lists, a few words) is searched by
its exact tokens instead: windows of five of them, or all of a shorter item, which then
must stand between sentence ends.

Defined results: null, empty and wordless texts have no windows and match nothing, as
items and as documents; every row of the benchmark is an item of its own, with the id it
has, also a null one, and equal rows are one item; repeated documents are judged alike;
ids keep their type; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import (
    claim,
    dense_blocks,
    identified,
    joined_blocks,
    keeping_names,
    map_batches,
    runs,
    scratch_table,
    small_side,
)

WINDOW = 5
PLAIN_WORDS = 3
COVERAGE = 0.8
#: Bloom filter: bits for each window of the benchmark, three probes, 64 MB at most.
BLOOM_BITS_EACH = 32
BLOOM_MOST_BITS = 29
#: A worker forgets its chunks beyond so many, some 200 bytes each.
CACHE_CHUNKS = 120_000
RUN_BYTES = 2 << 20
ROW = "_tabscope_row"

NUMBER_WORDS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    " sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty"
    " ninety hundred thousand million billion half dozen".split()
)
#: Words taken as a unit right after a number.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ounce ounces pound pounds"
    " ton tons tonne tonnes ml l liter liters litre litres gallon gallons second seconds minute"
    " minutes hour hours day days week weeks month months year years cent cents dollar dollars"
    " euro euros percent degree degrees meter meters metre metres gram grams kilogram kilograms"
    " kilometer kilometers kilometre kilometres centimeter centimeters mph kmh".split()
)

_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n]")
_PLAIN, _CAPITAL, _NUMBER, _UNIT, _STOP = range(5)
_TYPES = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_NAME_SLOT, _NUMBER_SLOT, _UNIT_SLOT = 1, 2, 3
_PRIME = np.uint64(0x9FB21C651E98DF25)


_KINDS = dict.fromkeys(UNITS, _UNIT) | dict.fromkeys(NUMBER_WORDS, _NUMBER)
_KINDS |= dict.fromkeys(".!?\n", _STOP)


def _key(token: str) -> bytes:
    """61-bit hash of the lower-cased token, and its kind, in eight bytes."""
    low = token.lower()
    kind = _KINDS.get(low)
    if kind is None:
        if token[0].isdigit():
            kind = _NUMBER
        elif token[0].isupper() and len(token) > 1 and not token.isupper():
            kind = _CAPITAL
        else:
            kind = _PLAIN
    return (xxhash.xxh3_64_intdigest(low.encode()) >> 3 << 3 | kind).to_bytes(8, "little")


class _Chunks(dict):
    """What stands between two spaces, to the keys of its tokens."""

    def __missing__(self, chunk: str) -> bytes:
        keys = _key(chunk) if chunk.isalpha() else b"".join(map(_key, _TOKEN.findall(chunk)))
        self[chunk] = keys
        return keys


_CHUNKS = _Chunks()


def token_keys(texts: pa.Array) -> list[np.ndarray]:
    """Keys of the tokens of every text; a chunk that repeats is looked at once."""
    if not len(texts):
        return []
    claim(_CHUNKS, _CHUNKS.clear)
    if len(_CHUNKS) > CACHE_CHUNKS:
        _CHUNKS.clear()
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    coded = lists.flatten().dictionary_encode()
    chunks = list(map(_CHUNKS.__getitem__, coded.dictionary.to_pylist()))
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks)) // 8
    every = np.frombuffer(b"".join(chunks), np.uint64)
    places = coded.indices.to_numpy()
    each = sizes[places]
    ends = np.cumsum(each)
    at = np.repeat((np.cumsum(sizes) - sizes)[places] - (ends - each), each)
    keys = every[at + np.arange(len(at))]
    bounds = np.append(0, ends)[lists.offsets.to_numpy()]
    return [keys[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def template(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, values) of a text's template; the value is 0 where the token is plain.

    A capitalised word is a name, and a run of names inside a sentence is one slot. A unit
    counts as one right after a number.
    """
    if not len(keys):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    kind = (keys & np.uint64(7)).astype(np.int8)
    opens = np.ones(len(kind), bool)
    opens[1:] = kind[:-1] == _STOP
    words = kind != _STOP
    keys, kind, opens = keys[words] >> np.uint64(3), kind[words], opens[words]
    slot = np.zeros(len(kind), np.int8)
    slot[kind == _NUMBER] = _NUMBER_SLOT
    slot[kind == _CAPITAL] = _NAME_SLOT
    after = np.zeros(len(kind), bool)
    after[1:] = kind[:-1] == _NUMBER
    slot[(kind == _UNIT) & after] = _UNIT_SLOT
    joined = np.zeros(len(kind), bool)
    joined[1:] = (slot[1:] == _NAME_SLOT) & (slot[:-1] == _NAME_SLOT) & ~opens[1:]
    codes = np.where(slot > 0, _TYPES[slot], keys)
    values = np.where(slot > 0, keys, np.uint64(0))
    if joined.any():
        first = np.flatnonzero(~joined)
        values = np.add.reduceat(values * np.where(joined, _PRIME, np.uint64(1)), first)
        codes = codes[first]
    return codes, values


def windows(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place) of the windows with enough plain words, and the template's values."""
    codes, values = template(keys)
    n = len(codes) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64), values
    h = codes[:n] * _PRIME
    for j in range(1, WINDOW):
        h ^= h >> np.uint64(29)
        h ^= codes[j : j + n]
        h *= _PRIME
    h ^= h >> np.uint64(29)
    filled = values != 0
    if not filled.any():
        return h, np.arange(n), values
    upto = np.concatenate([[0], np.cumsum(filled)])
    at = np.flatnonzero(upto[WINDOW:] - upto[:-WINDOW] <= WINDOW - PLAIN_WORDS)
    return h[at], at, values


def exact_windows(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of runs of ``size`` tokens as they are; short ones between stops only."""
    kind = keys & np.uint64(7)
    words = kind != _STOP
    opens = np.ones(len(keys), bool)
    opens[1:] = ~words[:-1]
    closes = np.ones(len(keys), bool)
    closes[:-1] = ~words[1:]
    opens, closes, keys = opens[words], closes[words], keys[words] >> np.uint64(3)
    n = len(keys) - size + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.full(n, np.uint64(size) * _TYPES[3])
    for j in range(size):
        h ^= h >> np.uint64(29)
        h ^= keys[j : j + n]
        h *= _PRIME
    h ^= h >> np.uint64(29)
    at = np.arange(n) if size == WINDOW else np.flatnonzero(opens[:n] & closes[size - 1 :])
    return h[at], at


def item_windows(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(hash, place, slots, size) of an item: of its template, else (size > 0) exact ones."""
    h, at, values = windows(keys)
    if len(h):
        return h, at, slots_of(values, at), 0
    size = min(WINDOW, int((keys & np.uint64(7) != _STOP).sum()))
    if not size:
        return h, at, np.zeros((0, WINDOW), np.uint64), 0
    if size < WINDOW:  # whole: it opens and closes itself
        keys = keys[keys & np.uint64(7) != _STOP]
    h, at = exact_windows(keys, size)
    return h, at, np.zeros((len(h), WINDOW), np.uint64), size


def slots_of(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values in each of the windows ``at``."""
    return values[at[:, None] + np.arange(WINDOW)]


_SCHEMA = "h long, place int, slots array<long>"


def _rows(h: np.ndarray, at: np.ndarray, slots: np.ndarray) -> list[pa.Array]:
    flat = pa.array(np.ascontiguousarray(slots).view(np.int64).reshape(-1))
    lists = pa.ListArray.from_arrays(np.arange(0, len(h) * WINDOW + 1, WINDOW, np.int32), flat)
    return [pa.array(h.view(np.int64)), pa.array(at.astype(np.int32)), lists]


def items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, text): the rows of a benchmark, numbered."""
    rows = benchmark.select("item_id", "text").distinct()
    return scratch_table(
        rows.withColumn("item", F.monotonically_increasing_id()), "decontamination-items"
    )


def benchmark_windows(numbered: DataFrame) -> DataFrame:
    """(item, h, place, slots, n, size): the windows of every item and how many it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, keys in zip(batch.column(0).to_pylist(), token_keys(batch.column(1)), strict=True):
                h, at, slots, size = item_windows(keys)
                fixed = [pa.array([item] * len(h), pa.int64()), *_rows(h, at, slots)]
                fixed += [pa.array(np.full(len(h), x, np.int32)) for x in (len(h), size)]
                yield pa.RecordBatch.from_arrays(
                    fixed, names=["item", "h", "place", "slots", "n", "size"]
                )

    return map_batches(numbered.select("item", "text"), run, f"item long, {_SCHEMA}, n int, size int")


def _bloom(hashes: DataFrame, count: int) -> np.ndarray:
    """A bit for each of three probes of every hash, as 64-bit words."""
    bits = min(BLOOM_MOST_BITS, max(16, (count * BLOOM_BITS_EACH - 1).bit_length()))
    probes = [F.shiftrightunsigned("h", 17 * j) for j in range(3)]
    places = hashes.select(F.explode(F.array(*probes)).alias("p")).select(
        F.col("p").bitwiseAND(F.lit((1 << bits) - 1)).alias("p")
    )
    words = places.groupBy(F.shiftright("p", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("mask")
    )
    blocks = dense_blocks(words, bits - 6, ["mask"]).toArrow()
    rows = zip(*(c.to_pylist() for c in blocks.columns), strict=True)
    return joined_blocks(rows, bits - 6, 1)[0].view(np.uint64)


def _maybe(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter may hold; a later probe sees what is left."""
    limit = np.uint64(len(bloom) * 64 - 1)
    left = np.arange(len(h))
    for j in range(3):
        p = h[left] >> np.uint64(17 * j) & limit
        left = left[bloom[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1) > 0]
    return left


def _consistent(pair: pd.DataFrame) -> pd.DataFrame:
    """Windows and slots of one document and item that agree along their alignment."""
    head = pair[["row", "item", "n"]].iloc[:1]
    item_place = pair["item_place"].to_numpy()
    due = np.stack(pair["item_slots"].to_numpy())
    if not due.any():
        return head.assign(found=len(np.unique(item_place)), slots=0, agreed=0)
    seen = np.stack(pair["slots"].to_numpy())
    shift = pair["place"].to_numpy() - item_place
    places: set[int] = set()
    slots: set[int] = set()
    agreed: set[int] = set()
    for run in np.unique(shift):
        mine = shift == run
        at = item_place[mine][:, None] + np.arange(WINDOW)
        d, s = due[mine], seen[mine]
        filled = d != 0
        each = set(zip(at[filled].tolist(), d[filled].tolist(), s[filled].tolist(), strict=True))
        # The pairs seen most often first; a value keeps its first partner on either side.
        good: dict[int, int] = {}
        taken: set[int] = set()
        often = Counter((a, b) for _, a, b in each)
        for (a, b), _ in sorted(often.items(), key=lambda x: (-x[1], x[0])):
            if a not in good and b not in taken:
                good[a] = b
                taken.add(b)
        slots.update(p for p, _, _ in each)
        agreed.update(p for p, a, b in each if good.get(a) == b)
        for place, ds, ss in zip(at[:, 0].tolist(), d.tolist(), s.tolist(), strict=True):
            if all(not a or good.get(a) == b for a, b in zip(ds, ss, strict=True)):
                places.add(place)
    return head.assign(found=len(places), slots=len(slots), agreed=len(agreed))


def matches(documents: DataFrame, numbered: DataFrame) -> DataFrame:
    """(ROW, item, found, n) of every document of ``documents(text, ROW)`` that holds an item.

    ``numbered`` is what :func:`items` gives. Only the size-capped Bloom filter reaches the
    driver, and the sizes of exact windows, of which there are WINDOW at most.
    """
    due = scratch_table(benchmark_windows(numbered), "decontamination-benchmark")
    count = due.count()
    exact = [r["size"] for r in due.where("size > 0").select("size").distinct().collect()]
    filter_ = documents.sparkSession.sparkContext.broadcast(_bloom(due.select("h"), count))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, RUN_BYTES):
            out = []
            ids = run.column(0).to_pylist()
            texts = run.column(1).combine_chunks()
            for row, keys in zip(ids, token_keys(texts), strict=True):
                h, at, values = windows(keys)
                every = [(h, at, values), *((*exact_windows(keys, n), None) for n in exact)]
                for h, at, values in every:
                    some = _maybe(filter_.value, h)
                    if not len(some):
                        continue
                    h, at = h[some], at[some]
                    slots = np.zeros((len(h), WINDOW), np.uint64) if values is None else slots_of(values, at)
                    out.append(
                        pa.RecordBatch.from_arrays(
                            [pa.array([row] * len(h), pa.int64()), *_rows(h, at, slots)],
                            names=["row", "h", "place", "slots"],
                        )
                    )
            yield from pa.Table.from_batches(out).combine_chunks().to_batches() if out else ()

    rows = documents.select(F.col(ROW).alias("row"), "text")
    maybe = map_batches(rows, hits, f"row long, {_SCHEMA}")
    known = small_side(due.select("h").distinct(), count, 24)
    found = scratch_table(maybe.join(known, "h", "left_semi"), "decontamination-hits")

    # The rarest windows of an item, as many as a contaminated document can't all miss.
    spread = due.select("h", "item").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("items"))
    ranked = due.join(spread, "h").select(
        "item",
        "h",
        (F.col("n") - F.ceil(F.col("n") * COVERAGE) + 1).alias("enough"),
        F.expr("row_number() over (partition by item order by items, h, place)").alias("nth"),
    )
    anchors = ranked.where("nth <= enough").select("item", "h").distinct()
    pairs = found.select("row", "h").distinct().join(small_side(anchors, count, 32), "h")
    pairs = pairs.select("row", "item").distinct()

    wanted = due.select(
        "item", "h", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "n"
    )
    joined = found.join(pairs, "row").join(small_side(wanted, count, 160), ["item", "h"])
    enough = joined.groupBy("row", "item").agg(
        F.count_distinct("item_place").alias("most"), F.first("n").alias("total")
    )
    enough = enough.where(F.col("most") >= F.col("total") * COVERAGE).select("row", "item")
    checked = (
        joined.join(enough, ["row", "item"], "left_semi")
        .groupBy("row", "item")
        .applyInPandas(_consistent, "row long, item long, n int, found int, slots int, agreed int")
    )
    whole = F.col("found") >= F.col("n") * COVERAGE
    return checked.where(whole & (F.col("agreed") >= F.col("slots") * COVERAGE)).select(
        F.col("row").alias(ROW), "item", "found", "n"
    )


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, windows found, windows of the item, coverage; a row per pair."""
    tagged = identified(documents.select("doc_id", "text"), ROW)
    numbered = items(benchmark)
    found = scratch_table(matches(tagged, numbered), "decontamination-found")
    count = found.count()
    return (
        tagged.select("doc_id", ROW)
        .join(small_side(found, count, 32), ROW)
        .join(numbered.select("item", "item_id"), "item")
        .select(
            "doc_id",
            "item_id",
            F.col("found").alias("windows_found"),
            F.col("n").alias("windows"),
            (F.col("found") / F.col("n")).alias("coverage"),
        )
    )


@keeping_names
def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they were."""
    tagged = identified(documents, ROW)
    found = matches(tagged, items(benchmark))
    gone = scratch_table(found.select(ROW).distinct(), "decontamination-gone")
    return tagged.join(small_side(gone, gone.count(), 32), ROW, "left_anti").drop(ROW)
