import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabscope.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in f.items():
        kept = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        lines = []
        for p, a in kept.items():
            inside = [
                x for q, x in kept.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ] if len(p) < 4 else []
            if any(100 * x >= 80 * a for x in inside):
                continue
            cuts = [(2000000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            lines.append((" ".join(p), a, found[p[:k]], found[p[k:]], n[lang], score))
        lines.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, rank, *x) for rank, x in enumerate(lines[:top], 1)]
    return sorted(out)


def compare(frame, least=30, top=2000):
    due = plain([(r.lang, r.text) for r in frame.select("lang", "text").collect()], least, top)
    made = sorted(tuple(r) for r in co.collocations(frame, least, top).collect())
    assert made == due
    return made


def test_documents(documents):
    assert len(compare(documents, 4, 150)) > 100


@pytest.mark.parametrize("period, tokens, bucket", [(1, 64, 1 << 10), (3, 1 << 20, 1 << 30), (10**9, 500, 4096)])
def test_any_parse_gives_the_same_counts(documents, monkeypatch, period, tokens, bucket):
    monkeypatch.setattr(co, "PERIOD", period)
    monkeypatch.setattr(co, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(co, "BUCKET_BYTES", bucket)
    compare(documents.where("doc_id % 5 = 0"), 3, 300)


def test_awkward_rows(awkward, nothing):
    compare(awkward, 2)
    assert co.collocations(nothing).count() == 0


def test_scores_cuts_and_cover(spark):
    text = " ".join(["new york city hall"] * 10 + ["new york"] * 5 + ["x y"] * 3) + ". a\tb, A B; a\nb!\x0ca  b"
    frame = spark.createDataFrame([("en", text), (None, text), (None, text), ("und", text)], "lang string, text string")
    compare(frame, 2)


def test_chunks_give_back_the_text(documents):
    for row in documents.limit(50).collect():
        chunks = co.chunks_of(row.text)
        tokens = [t for t in co.tokens_of(row.text) if t]
        own = [t for c in chunks for t in c.split(b" ")[: -co.CONTEXT]]
        assert own == tokens
        assert all(c.split(b" ")[-co.CONTEXT :] == d.split(b" ")[: co.CONTEXT] for c, d in zip(chunks, chunks[1:]) if len(d.split(b" ")) >= co.CONTEXT)


def test_a_hash_shared_by_two_phrases_adds_nothing(spark, monkeypatch):
    """All phrases of a block with one hash: counts are still those of each text."""
    block = co.Block("en", [b".", b"a", b"b"], np.array([1, 2, 1, 1, 2, 0], np.int32), np.ones(6, np.int64))
    monkeypatch.setattr(co.Block, "phrases", lambda self, n: (np.arange(4), np.zeros(4, np.int64)))
    found, _ = co._spelled(block, 2, np.zeros(1, np.int64))
    assert sorted(found) == [("en", b"a a", 1), ("en", b"a b", 2), ("en", b"b a", 1)]


def test_large_products(spark):
    big = 9 * 10**18
    rows = [("en", "a", big), ("en", "b", big), ("en", "a b", big - 1), ("en", "a b a", big // 5)]
    rows += [("en", "b a", big // 4)]
    scores = co.scored(spark.createDataFrame(rows, "lang string, phrase string, f long")).collect()
    assert {r.phrase: r.score for r in scores}["a b"] == 2000000 * (big - 1) // (2 * big)
    # 100 * f(longer) >= 80 * a: 20 per cent does not cover "a b", 80 per cent covers "b a".
    assert {r.phrase for r in scores} == {"a b", "a b a"}


def test_blocks_round_trip():
    weights = np.array([3, 3, 0, 0, 7, 0, 0, 0], np.int64)
    block = co.Block("de", [b".", b"x", b"y"], np.array([1, 2, 1, 0, 2, 1, 2, 0], np.int32), weights)
    fields = [name for name, _ in co._BLOCK_FIELDS]
    back = co.Block.read(dict(zip(fields, block.row(5), strict=True)))
    assert (back.lang, back.words) == (block.lang, block.words)
    assert back.ids.tolist() == block.ids.tolist() and back.weights.tolist() == weights.tolist()
    assert block.row(5)[-1] == 3 + 3 + 7
