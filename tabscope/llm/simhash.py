"""Near-duplicates by SimHash, found through anchor points of a covering code.

A fingerprint is cut into segments. Two fingerprints that differ in at most t bits differ
in at most t // segments bits of some segment. On every segment a covering code is laid:
each word lies within the code's covering radius of an anchor, its home. A fingerprint is
replicated to each anchor within covering radius plus the segment's threshold, so that it
meets every partner in the partner's home cell, where whole fingerprints are compared.

Codes with more anchors replicate more and compare less. All give the same links; the
one that costs least for the counted number of fingerprints is taken.

Copies share a fingerprint and meet as one row. A cell with very many homes is dealt over
several tasks, and a task sends a spanning forest of its links, never all pairs.

Defined results: a null, empty or blank text has no words and the fingerprint 0, and is
linked like any other; repeated rows are copies; a null doc_id takes part but is never the
smallest of its component unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.llm.common import (
    appended,
    claim,
    content_order,
    identified,
    keeping_names,
    scratch_table,
    small_side,
    words_of,
)
from tabscope.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Homes of a cell that meet in one task; larger cells are dealt out.
CELL_HOMES = 4096
_CHUNK = 1 << 15
ROW = "_tabscope_row"


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of word shingles, as a signed integer; 0 for a text without words."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words).lower()  # bytes.lower() changes A-Z only
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(joined)]
    if len(words) >= width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = [0], [len(joined)]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        cut = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        raw = b"".join([digest(joined[a:b], SEED) for a, b in cut])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(starts)).view(">i8")[0])


def with_fingerprints(
    documents: DataFrame, name: str = "fp", width: int = SHINGLE_WORDS
) -> DataFrame:
    def run(texts: pa.Array) -> list:
        claim(fingerprint, lambda: None)  # keeps nothing, and lets go of what others kept
        return [[fingerprint(t, width) for t in texts.to_pylist()]]

    return appended(documents, ["text"], run, [T.StructField(name, T.LongType())])


# Codes ---------------------------------------------------------------------------------


@cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Byte-wise syndromes of the perfect [23,12] code, and the leader of each syndrome."""
    generator = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
    # Remainders of single bits; the remainder of a word is their XOR.
    single = []
    for bit in range(23):
        r = 1 << bit
        for top in range(22, 10, -1):
            if r >> top & 1:
                r ^= generator << (top - 11)
        single.append(r)
    bytes_ = np.zeros((3, 256), np.uint32)
    for byte in range(3):
        for value in range(256):
            for i in range(8):
                if value >> i & 1 and 8 * byte + i < 23:
                    bytes_[byte, value] ^= single[8 * byte + i]
    leaders = np.zeros(1 << 11, np.uint32)
    one = [(1 << i, single[i]) for i in range(23)]
    for i, (e1, s1) in enumerate(one):
        leaders[s1] = e1
        for j in range(i):
            e2, s2 = one[j]
            leaders[s1 ^ s2] = e1 | e2
            for e3, s3 in one[:j]:
                leaders[s1 ^ s2 ^ s3] = e1 | e2 | e3
    return bytes_, leaders


def _golay_home(x: np.ndarray) -> np.ndarray:
    """The only codeword within 3 bits of each 23-bit word."""
    tables, leaders = _golay()
    s = tables[0][x & 255] ^ tables[1][x >> 8 & 255] ^ tables[2][x >> 16 & 255]
    return x ^ leaders[s].astype(x.dtype)


def _hamming_home(x: np.ndarray) -> np.ndarray:
    """The only codeword within 1 bit of each 31-bit word: bit i has the syndrome i + 1."""
    s = np.zeros(x.shape, np.uint64)
    for i in range(31):
        s ^= (x >> np.uint64(i) & np.uint64(1)) * np.uint64(i + 1)
    flip = np.where(s > 0, np.left_shift(np.uint64(1), (s - np.uint64(1)) & np.uint64(63)), 0)
    return x ^ flip.astype(np.uint64)


@dataclass(frozen=True)
class Code:
    """``segments`` pieces; the low ``coded`` bits of each by a perfect code, the rest as is."""

    name: str
    segments: int
    coded: int
    anchors: int  # of one segment
    replicas: int  # of one fingerprint, over all segments, about

    def pieces(self) -> list[tuple[int, int]]:
        cuts = [64 * i // self.segments for i in range(self.segments + 1)]
        return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]

    def home(self, x: np.ndarray) -> np.ndarray:
        low = np.uint64((1 << self.coded) - 1)
        solve = _golay_home if self.coded == 23 else _hamming_home
        return x & ~low | solve(x & low)

    def cells(self, fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(cell, fingerprint, home?) for every anchor near enough, segment by segment."""
        reach = bits // self.segments
        for number, (at, width) in enumerate(self.pieces()):
            x = fps >> np.uint64(at) & np.uint64((1 << width) - 1)
            own = self.home(x)
            tag = np.uint64(number) << np.uint64(60)
            yield own | tag, fps, True
            flips = [1 << i for i in range(width)] if reach else []
            flips += [a | b for i, a in enumerate(flips) for b in flips[:i]] if reach > 1 else []
            if reach > 2:
                raise ValueError("at most two differing bits a segment are covered")
            if not flips:
                continue
            near = np.stack([own, *(self.home(x ^ np.uint64(e)) for e in flips)])
            near.sort(axis=0)
            new = np.ones(near.shape, bool)
            new[1:] = near[1:] != near[:-1]
            new &= near != own
            which = np.nonzero(new)
            yield near[which] | tag, fps[which[1]], False


#: Golay's code fits 23 bits, Hamming's 31; a shorter segment leaves upper bits zero.
CODES = (
    Code("golay-3x21", 3, 23, 1 << 12, 16),
    Code("golay-2x32", 2, 23, 1 << 21, 212),
    Code("hamming-2x32", 2, 31, 1 << 27, 344),
)


def cheapest(n: int, bits: int) -> Code:
    """By rows moved (1 us each) and pairs compared (3 ns each)."""

    def cost(code: Code) -> float:
        a_segment = code.replicas / code.segments
        return 1e-6 * n * code.replicas + 3e-9 * n * n * code.segments * a_segment / code.anchors

    return min((c for c in CODES if bits // c.segments <= 2), key=cost)


# Links ---------------------------------------------------------------------------------


def _replicas(code: Code, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 2048):
                for cell, fp, home in code.cells(fps[at : at + 2048], bits):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell.view(np.int64)),
                            pa.array(np.ascontiguousarray(fp).view(np.int64)),
                            pa.array(np.full(len(cell), home)),
                        ],
                        names=["cell", "fp", "home"],
                    )

    return run


def _compare(bits: int):
    """Links of each (cell, deal) run of rows; homes come first, the rest is streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes = np.empty(0, np.uint64)
        label = np.empty(0, np.int64)  # of the homes: equal once links join them
        key = None
        for batch in batches:
            cell, deal, fp, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(cell):
                continue
            fp = fp.view(np.uint64)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (deal[1:] != deal[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(cell)], strict=True):
                if (cell[a], deal[a]) != key:
                    key, homes, label = (cell[a], deal[a]), homes[:0], label[:0]
                mine = fp[a:b][home[a:b]]
                if len(mine):
                    label = np.r_[label, np.arange(len(homes), len(homes) + len(mine))]
                    homes = np.r_[homes, mine]
                if not len(homes):
                    continue
                step = max(1, (1 << 20) // len(homes))
                for s in range(a, b, step):
                    part = fp[s : min(s + step, b)]
                    close = np.bitwise_count(part[:, None] ^ homes[None, :]) <= bits
                    close &= part[:, None] != homes[None, :]
                    rows = np.flatnonzero(close.any(axis=1))
                    if not len(rows):
                        continue
                    close = close[rows]
                    first = close.argmax(axis=1)
                    found.append((part[rows], homes[first]))
                    # A row links to its first home; its other homes join that one.
                    low = np.where(close, label, len(homes)).min(axis=1)
                    high = np.where(close, label, -1).max(axis=1)
                    for r in np.flatnonzero(low != high):
                        labels = label[close[r]]
                        apart, where = np.unique(labels, return_index=True)
                        if len(apart) > 1:
                            others = homes[close[r]][where]
                            found.append((others[1:], np.repeat(others[:1], len(others) - 1)))
                            label[np.isin(label, apart)] = apart[0]
            u = np.concatenate([f[0] for f in found] or [homes[:0]]).view(np.int64)
            v = np.concatenate([f[1] for f in found] or [homes[:0]]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def links(
    fingerprints: DataFrame, n: int, bits: int = MAX_BITS, code: Code | None = None
) -> DataFrame:
    """(u, v): links that connect whatever fingerprints ``fp`` differ in at most ``bits``.

    ``fingerprints(fp)`` holds each once; ``n`` is their number. Connected sets are whole;
    of the links inside a cell only a spanning forest is sent.
    """
    code = code or cheapest(n, bits)
    copies = fingerprints.select("fp").mapInArrow(
        _replicas(code, bits), "cell long, fp long, home boolean"
    )
    crowded = (
        copies.where("home")
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("homes"))
        .where(F.col("homes") > CELL_HOMES)
        .select("cell", F.ceil(F.col("homes") / CELL_HOMES).cast("int").alias("deals"))
    )
    # At most n / CELL_HOMES cells of a segment are crowded.
    crowded = small_side(crowded, code.segments * (n // CELL_HOMES + 1), 32)
    deals = F.coalesce("deals", F.lit(1))
    own = F.col("home") & (F.pmod(F.xxhash64("fp"), deals) == F.col("deal"))
    dealt = (
        copies.join(crowded, "cell", "left")
        .withColumn("deal", F.explode(F.sequence(F.lit(0), deals - 1)))
        .select("cell", "deal", "fp", own.alias("home"))
        .repartition("cell", "deal")
        .sortWithinPartitions("cell", "deal", F.desc("home"))
    )
    return dealt.mapInArrow(_compare(bits), "u long, v long")


def classes(fingerprints: DataFrame, bits: int = MAX_BITS, code: Code | None = None) -> DataFrame:
    """(fp, root, component_id) of fingerprints that several documents share or that link.

    ``fingerprints(doc_id, fp)``: one row per document. All others stand alone. The root
    names a component even where none of its documents has an id.
    """
    groups = scratch_table(
        fingerprints.groupBy("fp").agg(
            F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")
        ),
        "simhash-groups",
    )
    linked = components(links(groups, groups.count(), bits, code))
    members = linked.join(groups, linked["node"] == groups["fp"]).select("fp", "root", "first")
    smallest = members.groupBy("root").agg(F.min("first").alias("component_id"))
    found = members.join(smallest, "root").select("fp", "root", "component_id")
    alone = groups.where("copies > 1").join(found, "fp", "left_anti")
    return found.unionAll(
        alone.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    )


def near_duplicates(
    documents: DataFrame, width: int = SHINGLE_WORDS, bits: int = MAX_BITS, code: Code | None = None
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = with_fingerprints(documents.select("doc_id", "text"), "fp", width).drop("text")
    rows = scratch_table(prints, "simhash-fingerprints")
    found = classes(rows, bits, code)
    alone = F.when(found["fp"].isNull(), rows["doc_id"]).otherwise(F.col("component_id"))
    return rows.join(found, rows["fp"] == found["fp"], "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex(rows["fp"]), 16, "0")).alias("fingerprint"),
        alone.alias("component_id"),
    )


@keeping_names
def one_of_each(
    documents: DataFrame, width: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """``documents`` with one row of each component: one with its smallest doc_id.

    Of several with that id it is the first by a hash of their values, wherever they are
    stored.
    """
    tagged = identified(documents, ROW)
    first, second = content_order(documents, SEED)
    narrow = tagged.select("doc_id", "text", ROW, first.alias("order"), second.alias("tie"))
    prints = with_fingerprints(narrow, "fp", width).drop("text")
    rows = scratch_table(prints, "simhash-fingerprints")
    found = scratch_table(classes(rows, bits).select("fp", "root"), "simhash-classes")
    several = rows.join(found, "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "order", "tie", ROW)
    # Copies combine on the map side, per fingerprint, before their component is known.
    kept = rows.groupBy("fp").agg(F.min(order).alias("least")).join(found, "fp")
    kept = kept.groupBy("root").agg(F.min("least").alias("least"))
    stay = kept.select(F.col(f"least.{ROW}").alias(ROW))
    gone = scratch_table(several.select(ROW).join(stay, ROW, "left_anti"), "simhash-gone")
    return tagged.join(small_side(gone, gone.count(), 32), ROW, "left_anti").drop(ROW)
