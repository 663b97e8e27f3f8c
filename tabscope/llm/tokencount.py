"""Token counts of a unigram tokenizer without making the tokens.

A text is cut at spaces as the tokenizer does (a word carries the mark of the space before
it). Aho-Corasick enumerates every vocabulary piece that ends at a place of a word, and
dynamic programming carries the best score and the number of pieces of the best path to
it, with the tokenizer's own rules: scores add in the order of the text; of equal paths
the one whose last piece starts first wins; a character that is no piece of its own may
stand alone at ten below the lowest score, and counts as its bytes where the vocabulary
has byte pieces, else a run of such characters counts once.

A worker keeps the counts of words it has seen, up to a bound.

Defined results: null and empty texts have no tokens; very long words are counted whole
and not kept; repeated rows are counted alike.
"""

from __future__ import annotations

from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabscope.llm.common import appended, claim

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 600_000
CACHE_LETTERS = 64


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.IdToPiece(i), model.GetScore(i)) for i in range(model.GetPieceSize())]


class Counter(dict):
    """Word (with its mark) to its number of pieces."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        super().__init__()
        self.trie = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        known = {p for p, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in known for b in range(256))
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        n = self.pieces(word)
        if len(word) <= CACHE_LETTERS:
            self[word] = n
        return n

    def pieces(self, word: str) -> int:
        size = len(word)
        score = [0.0] * (size + 1)
        count = [0] * (size + 1)
        lone = [False] * (size + 1)  # the best path ends with a character that is no piece
        found = self.trie.iter(word)
        end, match = next(found, (size, None))
        for at in range(size):
            best = None
            single = False
            while end == at:
                # Longest first: an equal score never replaces an earlier start.
                length, value = match
                start = at + 1 - length
                total = value + score[start]
                if best is None or total > best:
                    best, begun = total, start
                single = single or length == 1
                end, match = next(found, (size, None))
            alone = False
            if not single:
                total = self.unknown + score[at]
                if best is None or total > best:
                    best, begun, alone = total, at, True
            score[at + 1] = best
            lone[at + 1] = alone
            if not alone:
                count[at + 1] = count[begun] + 1
            elif self.bytes:
                count[at + 1] = count[at] + len(word[at].encode())
            else:
                count[at + 1] = count[at] + (not lone[at])
        return count[size]

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        claim(self, self.clear)
        if len(self) > CACHE_WORDS:
            self.clear()
        words = text.replace(MARK, " ").split(" ")
        if words[0] == "":  # the text brings its own leading mark
            words = words[1:]
        return sum(map(self.__getitem__, [MARK + w for w in words]))


@cache
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def with_counts(documents: DataFrame, path: str, name: str = "n_tokens") -> DataFrame:
    def run(texts: pa.Array) -> list:
        counts = counter(path)
        return [[counts.of(t) for t in texts.to_pylist()]]

    return appended(documents, ["text"], run, [T.StructField(name, T.LongType())])


def token_counts(documents: DataFrame, path: str) -> DataFrame:
    """doc_id and n_tokens of every document."""
    return with_counts(documents.select("doc_id", "text"), path).select("doc_id", "n_tokens")
