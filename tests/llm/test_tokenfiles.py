import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from tokenizers import Tokenizer

from tabscope.llm import tokenfiles as tf
from tabscope.llm.common import files_at, scratch_dir, scratch_table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(frame):
    tokenizer = Tokenizer.from_file(PATH)
    pairs = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    out = []
    for doc_id, text in pairs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return sorted(out, key=repr)


def same(frame):
    got = [tuple(r) for r in tf.token_files(frame, PATH).collect()]
    assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == plain(frame)
    # Documents follow each other in ascending order of their ids, without gaps.
    ordered = sorted(got, key=lambda r: r[1])
    ids = [d if d is not None else float("inf") for d, _, _, _ in ordered]
    assert ids == sorted(ids)
    at = 0
    for _, start, n, _ in ordered:
        assert start == at
        at += n


def test_documents(documents):
    same(documents)


def test_many_shards(documents, monkeypatch):
    monkeypatch.setattr(tf, "SHARD_BYTES", 20_000)
    same(documents)


def test_tasks_stay_under_their_bound_and_write_several_shards(documents, monkeypatch):
    monkeypatch.setattr(tf, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(tf, "MOST_TASKS", 3)
    monkeypatch.setattr(tf, "SHARD_IDS", 5_000)
    folder = scratch_dir(documents.sparkSession, "few-tasks")
    shards = tf.write_token_files(documents, folder, PATH).collect()
    assert len({r.shard >> 32 for r in shards}) <= 3 < len(shards)
    same(documents)


def test_a_task_that_runs_twice_changes_nothing(documents, monkeypatch):
    def twice(frame, name):
        if name == "token-shards":
            frame.write.format("noop").mode("overwrite").save()
        return scratch_table(frame, name)

    monkeypatch.setattr(tf, "scratch_table", twice)
    folder = scratch_dir(documents.sparkSession, "twice")
    shards = tf.write_token_files(documents, folder, PATH)
    fs, path = files_at(folder)
    there = [i.base_name for i in fs.get_file_info(pafs.FileSelector(path)) if i.base_name.endswith(".pfor")]
    assert len(there) == 2 * shards.count()
    got = sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in tf.read_token_files(shards).collect()), key=repr)
    assert got == plain(documents)


def test_awkward_and_empty(awkward, nothing):
    same(awkward)
    assert tf.token_files(nothing, PATH).count() == 0


@pytest.mark.parametrize("size", [256, 2560])
def test_blocks_round_trip(size):
    rng = np.random.default_rng(1)
    kinds = [
        np.zeros(size),
        np.full(size, 2**32 - 1),
        rng.integers(0, 50_257, size),
        np.where(rng.random(size) < 0.01, 2**32 - 1, rng.integers(7, 9, size)),
        rng.integers(0, 2**32, size),
    ]
    for ids in (k.astype("<u4") for k in kinds):
        blocks = tf.encode_blocks(ids)
        sizes = np.array([len(b) for b in blocks])
        assert np.array_equal(tf.decode_blocks(b"".join(blocks), np.cumsum(sizes) - sizes), ids)


def test_outliers_do_not_widen_a_block():
    ids = np.full(256, 5, "<u4")
    ids[[3, 200]] = 50_000
    (block,) = tf.encode_blocks(ids)
    assert len(block) == tf._HEAD.size + 2 * 5  # width 0, two outliers


def test_chunks_encode_like_whole_texts():
    encode = tf.encoder(PATH)
    random.seed(3)
    parts = [" ", "  ", "\n", "\t", "a", "Hello", "word.", "x,", ",", ".", "'s", "don't", "é", "日本"]
    parts += ["😀", "1", "½", " ", " ", "\x1c", "<|endoftext|>", "|", "\r\n", "3.", "_", "​"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(5000)]
    want = [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encode(pa.array(texts))] == want
    assert encode(pa.array([], pa.string())) == []


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = tf.encoder(path)
    assert not encode.chunked
    want = Tokenizer.from_file(path).encode("Hello there,  world", add_special_tokens=False).ids
    assert encode(pa.array(["Hello there,  world"]))[0].tolist() == want


def test_packing_needs_little_memory():
    """A shard of many ids is packed in small runs, with the same blocks."""
    import io
    import tracemalloc

    ids = np.random.default_rng(7).integers(0, 50_000, 2 << 20).astype("<u4")
    documents = [(n, part.tobytes()) for n, part in enumerate(np.array_split(ids, 3000))]
    out = io.BytesIO()
    tracemalloc.start()
    tf._write_shard(out, iter(documents))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 40 << 20
    read = np.concatenate([tokens for _, _, tokens in tf.read_shard(out.getvalue())])
    assert (read == ids).all()


_THREADS = """
import os, sys
import pyarrow as pa
from tabscope.llm.tokenfiles import Encoder
words = [f"{a}{b}'{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"] * 4
before = len(os.listdir("/proc/self/task"))
encode = Encoder(sys.argv[1])
encode(pa.array([" ".join(words)] * 100))
print(len(os.listdir("/proc/self/task")) - before)
"""


def test_the_tokenizer_starts_no_threads_in_a_task():
    root = str(Path(tf.__file__).parents[2])
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": root}
    made = subprocess.run(
        [sys.executable, "-c", _THREADS, PATH], env=env, capture_output=True, text=True, check=True
    )
    assert int(made.stdout) == 0


def test_words_of_letters_are_one_call_of_the_model():
    """Nothing but the first chunk of a text and words of other characters is pre-tokenized."""
    asked = []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    letters = ["word", "Straße", "ÀÖØöøſ", "Привет", "ΑΡαω", "É", "zzqxv"]
    others = ["x1", "a-b", "중국", "end.\nNext", "end.\n\nNext", "two\n", "\nthree", "a\n\tb", "x÷y", "΢"]
    text = " ".join([*others[:1], *letters, *others, *letters])
    encode = tf.Encoder(PATH)
    want = encode.tokenizer.encode(text, add_special_tokens=False).ids
    encode.tokenizer = Counting(encode.tokenizer)
    assert encode(pa.array([text]))[0].tolist() == want
    assert not any(f" {word}" in call for call in asked for word in letters)
