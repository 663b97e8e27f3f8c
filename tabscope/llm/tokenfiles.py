"""Token-id files in patched frame-of-reference blocks.

A shard file holds the token ids of consecutive documents, 256 ids a block. A block keeps
its minimum, packs the differences at a width that a percentile of them fits, and lists
the outliers: their places and full differences. Little-endian throughout:

    b"PFOR0001"
    blocks:  minimum u32, width u8, outliers u16, 32 * width bytes of packed differences
             (bit i * width of the block on, as in a row of 64-bit words),
             outlier places u8 each, outlier differences u32 each
    index:   start of every block u64; ids before every document u64 and after the last;
             doc_id i64 and a byte that is 0 for a null id, each for every document
    tail:    blocks u64, documents u64, ids u64, start of the index u64, b"PFOR0001"

Documents are dealt over tasks by ranges of doc_id, so that shard after shard and document
after document the ids ascend. A task has some 12 MB of text and writes one shard; beyond a
number of tasks each has more, and writes several. A shard is what the returned row names:
files get names of their own, so a task that runs twice leaves a file nobody reads, and
never writes over one that somebody does.

Texts are encoded with a file of the tokenizers library. Where the tokenizer is a plain
byte-level one, a text is cut before each single space that precedes a word, where its
pieces never join, and of the chunks of a shard each distinct one is encoded once.

Defined results: a null or empty text is the end id alone; null ids come last; documents
with equal ids keep the order of their text's hash; empty tables give no shard.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import (
    claim,
    files_at,
    identified,
    map_batches,
    runs,
    scratch_dir,
    scratch_table,
    small_side,
)
from tabscope.operators.ranking import global_running

MAGIC = b"PFOR0001"
BLOCK = 256
#: The packed width fits this share of a block's differences; the others are outliers.
FITS = 0.98
SHARD_BYTES = 12 << 20
#: Tasks at most, whatever the size, and ids after which a task begins another shard.
MOST_TASKS = 20_000
SHARD_IDS = 8 << 20
#: Texts encoded at once: a chunk that comes twice in them is encoded once.
ENCODE_BYTES = 4 << 20
#: Words a worker remembers the ids of, some 40 bytes each.
KNOWN_WORDS = 300_000
END_ID = 2
ROW = "_tabscope_row"
_HEAD = struct.Struct("<IBH")
_TAIL = struct.Struct("<QQQQ8s")
#: Ids packed at once: each takes some 60 bytes while it is.
_WRITE_IDS = 1 << 18


# Blocks --------------------------------------------------------------------------------


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 256) differences to (blocks, 32 * width) bytes."""
    words = np.zeros((4 * width, len(values)), np.uint64)
    columns = np.ascontiguousarray(values.T)
    for i in range(BLOCK if width else 0):
        word, shift = divmod(i * width, 64)
        words[word] |= columns[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8)


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(raw).view("<u8").T) if width else raw
    out = np.zeros((BLOCK, raw.shape[0]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK if width else 0):
        word, shift = divmod(i * width, 64)
        out[i] = words[word] >> np.uint64(shift)
        if shift + width > 64:
            out[i] |= words[word + 1] << np.uint64(64 - shift)
        out[i] &= mask
    return out.T


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """One byte string per block; ``ids`` fill whole blocks."""
    rows = ids.reshape(-1, BLOCK)
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    last = int(np.ceil(FITS * BLOCK)) - 1
    nth = np.partition(rows, last, axis=1)[:, last]
    widths = np.ceil(np.log2(nth.astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        mine = rows[which].astype(np.uint64)
        outlier = mine >> np.uint64(width) > 0
        packed = _pack(np.where(outlier, np.uint64(0), mine), int(width))
        counts = outlier.sum(axis=1)
        for k, block in enumerate(which.tolist()):
            head = _HEAD.pack(int(least[block]), int(width), int(counts[k]))
            tail = b""
            if counts[k]:
                places = np.flatnonzero(outlier[k])
                tail = places.astype(np.uint8).tobytes() + mine[k][places].astype("<u4").tobytes()
            out[block] = head + packed[k].tobytes() + tail
    return out


def _slices(data: bytes, starts: np.ndarray, size: int) -> np.ndarray:
    """(starts, size) bytes of ``data``."""
    parts = [data[a : a + size] for a in starts.tolist()]
    return np.frombuffer(b"".join(parts), np.uint8).reshape(len(starts), size)


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``data``."""
    if not len(starts):
        return np.empty(0, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    starts = starts.astype(np.int64)
    head = _slices(data, starts, _HEAD.size)
    least = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
    widths = head[:, 4].astype(np.int64)
    counts = np.ascontiguousarray(head[:, 5:7]).view("<u2")[:, 0].astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        body = _slices(data, starts[which] + _HEAD.size, 32 * int(width))
        out[which] = _unpack(body, int(width))
    if counts.any():
        after = starts + _HEAD.size + 32 * widths
        block = np.repeat(np.arange(len(starts)), counts)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = raw[after[block] + nth]
        at = after[block] + counts[block] + 4 * nth
        value = np.ascontiguousarray(raw[at[:, None] + np.arange(4)]).view("<u4")[:, 0]
        out[block, place] = value
    out += least[:, None]
    return out.reshape(-1)


# Encoding ------------------------------------------------------------------------------

#: All that any library here takes for white space.
_BLANK = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
#: White space but for single line ends inside a word.
_SPACE = r"[\t\x0B\f\r\x1C-\x1F\x{85}\p{Z}]|\A\n|\n(?:\n|\z)"
_LOOSE = rf" (?:[{_BLANK}]|\z)"
_ENDED = r"[\p{L}\p{N}][,.]\z"
_CUT = re.compile(r" (?=\S)")
#: Words of letters alone, of blocks that were letters in every version of Unicode.
_LETTERS = r"\A[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{17F}\x{391}-\x{3A1}\x{3B1}-\x{3C9}\x{410}-\x{44F}]+\z"
#: Words of one call of the tokenizer, and words whose pieces are Python objects at once.
_RUN = 64
_RUN_LETTERS = 4096
#: The characters that a byte-level tokenizer writes bytes as: themselves, where they can be seen.
_SEEN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_UNSEEN = [b for b in range(0x100) if b not in _SEEN]
_AS_CHARACTER = "".join(chr(b if b in _SEEN else 0x100 + _UNSEEN.index(b)) for b in range(0x100))
_LINE_END = _AS_CHARACTER[0x0A]


def _joined(words: pa.Array, size: int) -> list[str]:
    """Runs of ``size`` words, with a line end and a space between them."""
    cuts = np.append(np.arange(0, len(words), size), len(words)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(cuts, words), "\n ").to_pylist()


class Encoder:
    """Token ids of texts.

    A plain byte-level tokenizer is asked for every distinct chunk of the texts once; the
    chunks never become Python objects.
    """

    def __init__(self, path: str) -> None:
        # A task has one core: threads of the tokenizer's own would each keep memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        made = json.loads(self.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        bound = ("lstrip", "rstrip", "single_word", "normalized")
        marks = [ids.tolist() for ids in self._ids([",", ".", "\n"])]
        self.chunked = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", False)
            and not before.get("add_prefix_space", True)
            and made["normalizer"] is None
            and not made["truncation"]
            and not any(token[b] for token in made["added_tokens"] for b in bound)
            and all(len(ids) == 1 for ids in marks)
        )
        self.comma, self.stop, self.newline = (ids[0] if ids else -1 for ids in marks)
        self.forget()

    def forget(self) -> None:
        """Words met before, the first KNOWN_WORDS of them, and where their ids are: none."""
        self.known = pa.array([], pa.string())
        self.ids = np.empty(0, "<u4")
        self.starts = self.lengths = np.empty(0, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), _RUN):  # what the tokenizer returns is bulky
            done = self.tokenizer.encode_batch_fast(texts[i : i + _RUN], add_special_tokens=False)
            out += [np.array(e.ids, "<u4") for e in done]
        return out

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths) of distinct words, each as it stands after a space."""
        at = pc.index_in(words, value_set=self.known)
        fresh = at.is_null()
        new = words.filter(fresh)
        ids, starts, lengths = self._new_words(new)
        ids = np.concatenate([self.ids, ids])
        starts += len(self.ids)
        where = pc.fill_null(at, 0).to_numpy()
        all_starts = np.empty(len(words), np.int64)
        all_lengths = np.empty(len(words), np.int64)
        is_new = fresh.to_numpy(zero_copy_only=False)
        all_starts[is_new], all_lengths[is_new] = starts, lengths
        all_starts[~is_new] = self.starts[where[~is_new]]
        all_lengths[~is_new] = self.lengths[where[~is_new]]
        if len(self.known) + len(new) <= KNOWN_WORDS:
            self.known = pa.concat_arrays([self.known, new])
            self.ids = ids
            self.starts = np.concatenate([self.starts, starts])
            self.lengths = np.concatenate([self.lengths, lengths])
        return ids, all_starts, all_lengths

    def _new_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths) of words the tokenizer is asked for.

        A word of letters is one piece with the space before it, so that only the model is
        asked.
        """
        lettered = pc.match_substring_regex(words, _LETTERS)
        which = lettered.to_numpy(zero_copy_only=False)
        ids, lengths = self._letters(words.filter(lettered))
        more, at, sizes = self._mixed(words.filter(pc.invert(lettered)))
        starts = np.empty(len(words), np.int64)
        each = np.empty(len(words), np.int64)
        starts[which], each[which] = np.cumsum(lengths) - lengths, lengths
        starts[~which], each[~which] = at + len(ids), sizes
        return np.concatenate([ids, more]), starts, each

    def _letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of words of letters."""
        ids, lengths = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        tokenize = self.model.tokenize
        for run in _joined(words, _RUN_LETTERS):
            pieces = charmap_decode(f" {run}".encode(), "strict", _AS_CHARACTER)[0]
            found = [[t.id for t in tokenize(p)] for p in pieces.split(_LINE_END)]
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), "<u4"))
        return np.concatenate(ids), np.concatenate(lengths)

    def _mixed(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths) of words of any characters.

        A line end after a word is a piece of its own, so that one call of the tokenizer
        takes many words; words with other white space go alone.
        """
        odd = pc.or_(pc.match_substring_regex(words, _SPACE), pc.equal(words, ""))
        plain = words.filter(pc.invert(odd))
        runs = [f" {run}\n" for run in _joined(plain, _RUN)]
        ids = np.concatenate([np.empty(0, "<u4"), *self._ids(runs)])
        lines = np.cumsum(pc.count_substring(plain, "\n").to_numpy() + 1)
        ends = np.flatnonzero(ids == self.newline)[lines - 1]
        alone = self._ids([f" {w}" if w else "" for w in words.filter(odd).to_pylist()])
        starts = np.empty(len(words), np.int64)
        lengths = np.empty(len(words), np.int64)
        which = odd.to_numpy(zero_copy_only=False)
        starts[~which] = np.append(0, ends + 1)[: len(ends)]
        lengths[~which] = ends - starts[~which]
        lengths[which] = [len(a) for a in alone]
        starts[which] = len(ids) + np.cumsum(lengths[which]) - lengths[which]
        return np.concatenate([ids, *alone]), starts, lengths

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text."""
        if not self.chunked or not len(texts):
            return self._ids(texts.to_pylist())
        claim(self, self.forget)
        is_loose = pc.match_substring_regex(texts, _LOOSE)
        split = pc.split_pattern(texts.filter(pc.invert(is_loose)), " ")
        cut = [_CUT.split(t) for t in texts.filter(is_loose).to_pylist()]
        lists = pa.concat_arrays([split, pa.array(cut, split.type)])
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        places = coded.indices.to_numpy().copy()
        chunks = coded.dictionary
        # A comma or full stop after a letter or digit is a piece of its own.
        ended = pc.match_substring_regex(chunks, _ENDED)
        bases = pc.if_else(ended, pc.utf8_slice_codeunits(chunks, 0, -1), chunks).dictionary_encode()
        ids, starts, lengths = self._words(bases.dictionary)
        base = bases.indices.to_numpy()
        marked = ended.to_numpy(zero_copy_only=False)
        mark = np.where(pc.ends_with(chunks, ",").to_numpy(zero_copy_only=False), self.comma, self.stop)
        # The first chunk of a text has no space before it.
        heads, head = np.unique(places[offsets[:-1]], return_inverse=True)
        first = self._ids(chunks.take(pa.array(heads)).to_pylist())
        places[offsets[:-1]] = len(chunks) + head
        sizes = np.array([len(f) for f in first], np.int64)
        starts = np.concatenate([starts[base], len(ids) + np.cumsum(sizes) - sizes]).astype(np.int32)
        lengths = np.concatenate([lengths[base] + marked, sizes]).astype(np.int32)
        marked = np.concatenate([marked, np.zeros(len(first), bool)])
        ids = np.concatenate([ids, *first, ids[:0], [0]]).astype("<u4", copy=False)
        # Chunk after chunk; the place of a mark is filled afterwards.
        each = lengths[places]
        ends = np.cumsum(each, dtype=np.int64)
        at = np.repeat(starts[places] - (ends - each).astype(np.int32), each)
        at += np.arange(len(at), dtype=np.int32)
        out = ids[at]
        del at
        with_mark = np.flatnonzero(marked[places])
        out[ends[with_mark] - 1] = mark[places[with_mark]]
        bounds = np.append(0, ends)[offsets]
        order = np.argsort(is_loose.to_numpy(zero_copy_only=False), kind="stable")
        found: list[np.ndarray] = [out[:0]] * len(texts)
        for n, i in enumerate(order.tolist()):
            found[i] = out[bounds[n] : bounds[n + 1]]
        return found


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# Files ---------------------------------------------------------------------------------


def _write_shard(out: pa.NativeFile, documents: Iterator[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Blocks as they fill, then the index; returns numbers of documents and ids."""
    starts: list[np.ndarray] = []
    sizes: list[int] = []
    doc_ids: list[int | None] = []
    held: list[bytes] = []
    waiting = 0
    at = out.write(MAGIC)
    total = 0

    def flush(last: bool) -> None:
        nonlocal held, waiting, at
        ids = np.frombuffer(b"".join(held), "<u4")
        full = len(ids) // BLOCK * BLOCK
        rest = ids[full:]
        if last and len(rest):
            ids = np.concatenate([ids, np.full(BLOCK - len(rest), rest.min(), ids.dtype)])
            full, rest = len(ids), rest[:0]
        blocks = encode_blocks(ids[:full]) if full else []
        sizes_ = np.array([len(b) for b in blocks], np.uint64)
        starts.append(at + np.cumsum(sizes_) - sizes_)
        at += out.write(b"".join(blocks))
        held, waiting = [rest.tobytes()], len(rest)

    for doc_id, ids in documents:
        doc_ids.append(doc_id)
        sizes.append(len(ids) // 4)
        total += len(ids) // 4
        held.append(ids)
        waiting += len(ids) // 4
        if waiting >= _WRITE_IDS:
            flush(False)
    flush(True)
    every = np.concatenate(starts).astype("<u8")
    out.write(every.tobytes())
    out.write(np.concatenate([[0], np.cumsum(sizes)]).astype("<u8").tobytes())
    out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    out.write(np.array([d is not None for d in doc_ids], np.uint8).tobytes())
    out.write(_TAIL.pack(len(every), len(doc_ids), total, at, MAGIC))
    return len(doc_ids), total


def read_shard(data: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids before it in the shard, ids) of every document of a shard file."""
    blocks, documents, total, at, magic = _TAIL.unpack(data[-_TAIL.size :])
    if magic != MAGIC or data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    starts = np.frombuffer(data, "<u8", blocks, at)
    at += 8 * blocks
    before = np.frombuffer(data, "<u8", documents + 1, at).astype(np.int64)
    at += 8 * (documents + 1)
    doc_ids = np.frombuffer(data, "<i8", documents, at)
    known = np.frombuffer(data, np.uint8, documents, at + 8 * documents)
    ids = decode_blocks(data, starts)[:total]
    for i in range(documents):
        yield (int(doc_ids[i]) if known[i] else None), int(before[i]), ids[before[i] : before[i + 1]]


def write_token_files(
    documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID
) -> DataFrame:
    """Write shards below ``folder``; returns (shard, file, documents, ids), one row each."""
    rows = identified(documents, ROW).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), ROW
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text"), F.col(ROW)]
    tasks = min(size // SHARD_BYTES + 1, MOST_TASKS)
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    most = SHARD_IDS
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def encoded() -> Iterator[tuple[int | None, bytes]]:
            encode = encoder(tokenizer)
            for run in runs(batches, ENCODE_BYTES):
                ids = run.column(0).to_pylist()
                for doc_id, tokens in zip(ids, encode(run.column(1).combine_chunks()), strict=True):
                    yield doc_id, tokens.tobytes() + end

        found = encoded()
        head = next(found, None)
        part, made = TaskContext.get().partitionId(), 0
        fs, path = files_at(folder)
        while head is not None:
            # The document a shard ends with is the last one taken; the next begins another.
            def shard() -> Iterator[tuple[int | None, bytes]]:
                nonlocal head
                held = 0
                while head is not None and held < most:
                    held += len(head[1]) // 4
                    yield head
                    head = next(found, None)

            name = f"shard-{part:08d}-{made:06d}-{uuid.uuid4().hex}.pfor"
            with fs.open_output_stream(f"{path}/{name}") as out:
                documents, ids = _write_shard(out, shard())
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": [part << 32 | made],
                    "file": [f"{folder}/{name}"],
                    "documents": [documents],
                    "ids": [ids],
                }
            )
            made += 1

    made = map_batches(
        dealt.select("doc_id", "text"), write, "shard long, file string, documents long, ids long"
    )
    return scratch_table(made, "token-shards")


def read_token_files(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the shard files."""
    count = shards.count()
    offsets = global_running(shards.select("shard", "file", "ids"), [F.col("shard")], "nr", {"ids": "before"})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = files_at(file)
                with fs.open_input_stream(path) as stream:
                    data = stream.read()
                made = [
                    (doc_id, before + at, len(ids), zlib.crc32(ids.astype("<u4", copy=False)))
                    for doc_id, at, ids in read_shard(data)
                ]
                columns = [pa.array(list(c), pa.int64()) for c in zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    spread = offsets.repartition(max(1, min(count, MOST_TASKS)), "shard").select("file", "before")
    return map_batches(spread, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(documents: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write ``documents`` as token files and return what the files hold of each."""
    folder = folder or scratch_dir(documents.sparkSession, "tokens")
    return read_token_files(write_token_files(documents, folder, tokenizer))
