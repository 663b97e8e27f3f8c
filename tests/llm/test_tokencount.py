import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tabscope.llm import tokencount as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


def reference(pieces, byte_fallback):
    made = Tokenizer(models.Unigram(pieces, 0, byte_fallback))
    made.pre_tokenizer = pre_tokenizers.Metaspace()
    return lambda t: len(made.encode(t or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def count():
    return reference(tc.vocabulary(PATH), True)


def test_documents(documents, awkward, nothing, count):
    for frame in (documents, awkward):
        want = sorted(((r.doc_id, count(r.text)) for r in frame.collect()), key=repr)
        assert sorted(map(tuple, tc.token_counts(frame, PATH).collect()), key=repr) == want
    assert tc.token_counts(nothing, PATH).count() == 0


def test_odd_texts(count):
    random.seed(4)
    parts = ["a", " ", "  ", "▁", "\n", "é", "日本", "😀", "<0x0A>", "<s>", "the", "ing", "\x00", "ﬁ"]
    counter = tc.counter(PATH)
    for _ in range(3000):
        text = "".join(random.choices(parts, k=random.randint(0, 12)))
        assert counter.of(text) == count(text), repr(text)


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_ties_and_unknown_runs(byte_fallback):
    """Many equal scores, and characters the vocabulary lacks."""
    random.seed(5)
    letters = "abc"
    pieces = [("<unk>", 0.0), ("▁", -1.0)]
    for n in (1, 2, 3):
        for _ in range(6):
            piece = "".join(random.choices(letters, k=n))
            if piece not in dict(pieces) and piece != "c":
                pieces.append((piece, -float(random.randint(1, 3))))
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", -5.0) for b in range(256)]
    counter = tc.Counter(pieces)
    count = reference(pieces, byte_fallback)
    for _ in range(4000):
        text = "".join(random.choices("abcé ", k=random.randint(0, 14)))
        assert counter.of(text) == count(text), repr(text)
