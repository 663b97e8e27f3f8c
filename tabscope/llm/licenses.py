"""Licence scans through a positional index of licence texts.

Every distinct word of the licence templates weighs its IDF, counted over all documents.
The index lists for each word the templates and positions it stands at. A document looks
up the highest-IDF words it shares with a template; each occurrence proposes where the
template would start, and the postings of the other words are intersected with it by
relative position, within a slack that grows with the template's length (names, comment
marks and changed words move what follows). An alignment's coverage is the share of the
template's IDF that stands where it should. A template is found where an alignment covers
at least :data:`COVERAGE` and every mandatory phrase of the template stands, word by word,
inside the aligned span.

Looked up are the rarest words that hold more than 1 - COVERAGE of the template's weight:
an alignment that misses all of them can not reach the coverage, so none is lost.

Base phrases are found everywhere, aligned or not, and keep their labels.

Defined results: a null, empty or wordless text has no words, no labels and the score 0;
repeated rows are judged alike; a null doc_id is kept; an empty table gives no rows. The
score is the highest coverage of a template found; a base phrase counts as covered whole.
Texts are read whole; a worker holds one batch of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import map_batches

COVERAGE = 0.75
#: Words that may be moved: at least so many, and this share of the template's length.
LEAST_SLACK = 1
SLACK_SHARE = 0.1

#: Phrases of the contract and their labels.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)


@dataclass(frozen=True)
class Template:
    """A licence notice; ``phrases`` must stand in it and in what is found."""

    label: str
    text: str
    phrases: tuple[str, ...]


# Wording of public licence notices.
TEMPLATES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software.",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template("mit", "released under the MIT License", ("mit license",)),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an \"AS IS\""
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the"
        " License for the specific language governing permissions and limitations under the"
        " License.",
        ("in compliance with the license", "unless required by applicable law"),
    ),
    Template("apache", "licensed under the Apache License, Version 2.0", ("apache license",)),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version. This program is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even"
        " the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "gpl", "licensed under the GNU General Public License", ("gnu general public license",)
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms"
        " of the GNU Lesser General Public License as published by the Free Software Foundation;"
        " either version 2.1 of the License, or (at your option) any later version.",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU Affero General Public License as published by the Free Software Foundation,"
        " either version 3 of the License, or (at your option) any later version.",
        ("gnu affero general public license",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: Redistributions of source code"
        " must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
        ("redistribution and use in source and binary forms", "must retain the above copyright notice"),
    ),
    Template("bsd", "released under the BSD License", ("bsd license",)),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
        ("mozilla public license",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by"
        " any means.",
        ("free and unencumbered software", "public domain"),
    ),
    Template(
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event"
        " will the authors be held liable for any damages arising from the use of this software."
        " Permission is granted to anyone to use this software for any purpose, including"
        " commercial applications, and to alter it and redistribute it freely.",
        ("in no event will the authors be held liable", "alter it and redistribute it freely"),
    ),
    Template("cc-by", "licensed under CC BY 4.0", ("cc by 4",)),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc by nc 4",)),
    Template("cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0", ("cc by nc sa",)),
    Template("cc-by-nd", "licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template(
        "cc-by",
        "licensed under a Creative Commons Attribution 4.0 International License",
        ("creative commons attribution 4",),
    ),
    Template("cc0", "released under CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0 universal",)),
)

#: What is not a word turns into a space, A-Z into a-z; bytes from 0x80 on are of words.
_TO_WORDS = bytes(
    b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


class Index:
    """Templates as word numbers; which words stand where."""

    def __init__(
        self, templates: Sequence[Template] = TEMPLATES, base: Sequence[tuple[str, str]] = BASE
    ) -> None:
        self.number: dict[bytes, int] = {}
        self.base = [(self._numbers(phrase), label) for phrase, label in base]
        self.labels = [t.label for t in templates]
        self.sequences = [self._numbers(t.text) for t in templates]
        self.phrases = [[self._numbers(p) for p in t.phrases] for t in templates]
        for sequence, phrases in zip(self.sequences, self.phrases, strict=True):
            if not len(sequence) or not all(len(p) and len(_places(sequence, p)) for p in phrases):
                raise ValueError("a template holds words, and its mandatory phrases stand in it")
        self.needed = [np.unique(np.concatenate([s[:0], *p])) for s, p in zip(self.sequences, self.phrases, strict=True)]
        #: Per template: its distinct words and the positions of each.
        self.postings = [
            {int(w): np.flatnonzero(sequence == w) for w in np.unique(sequence)}
            for sequence in self.sequences
        ]

    def _numbers(self, text: str) -> np.ndarray:
        words = words_of(text)
        return np.array([self.number.setdefault(w, len(self.number)) for w in words], np.int32)

    def read(self, text: str | None) -> np.ndarray:
        """The text as word numbers, -1 for words that no template has."""
        words = words_of(text)
        number = self.number.get
        return np.array([number(w, -1) for w in words], np.int32)


def _places(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of a phrase in a sequence of word numbers."""
    n = len(ids) - len(phrase) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at = np.flatnonzero(ids[:n] == phrase[0])
    for i, w in enumerate(phrase[1:], 1):
        at = at[ids[at + i] == w]
    return at


def slack(length: int) -> int:
    return max(LEAST_SLACK, int(SLACK_SHARE * length))


def _near(ordered: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each range whether a value of ``ordered`` lies in it, ends included."""
    return np.searchsorted(ordered, low, "left") < np.searchsorted(ordered, high, "right")


class Scanner:
    """An index with the weight of every word."""

    def __init__(self, index: Index, weights: np.ndarray) -> None:
        self.index = index
        self.weights = weights
        self.looked_up = [self._rarest(p) for p in index.postings]

    def _rarest(self, postings: dict[int, np.ndarray]) -> list[int]:
        order = sorted(postings, key=lambda w: (-self.weights[w], w))
        total = sum(self.weights[w] for w in order)
        held, rarest = 0.0, []
        for w in order:
            if held > (1 - COVERAGE) * total * (1 + 1e-9):
                break
            held += self.weights[w]
            rarest.append(w)
        return rarest

    def coverage(self, template: int, ids: np.ndarray, at: dict[int, np.ndarray]) -> float:
        """Best coverage of a template by an alignment with all its phrases; 0 if too little.

        ``at``: places of each licence word of the document.
        """
        postings = self.index.postings[template]
        starts = {
            w: np.unique((at[w][:, None] - where[None, :]).ravel())
            for w, where in postings.items()
            if w in at
        }
        total = sum(self.weights[w] for w in postings)
        if sum(self.weights[w] for w in starts) < COVERAGE * total * (1 - 1e-9):
            return 0.0
        proposed = [starts[w] for w in self.looked_up[template] if w in starts]
        if not proposed:
            return 0.0
        x = np.unique(np.concatenate(proposed))
        length = len(self.index.sequences[template])
        room = slack(length)
        for phrase in self.index.phrases[template]:
            places = _places(ids, phrase)
            x = x[_near(places, x - room, x + length + room - len(phrase))]
        if not len(x):
            return 0.0
        covered = np.zeros(len(x))
        for w, where in starts.items():
            covered += self.weights[w] * _near(where, x - room, x + room)
        best = float(covered.max() / total)
        return min(best, 1.0) if best >= COVERAGE * (1 - 1e-9) else 0.0

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        index = self.index
        ids = index.read(text)
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return len(ids), 0, None, None, "", "", 0.0
        present = np.zeros(len(index.number), bool)
        present[ids[known]] = True
        places, base = [], set()
        for phrase, label in index.base:
            found = _places(ids, phrase) if present[phrase].all() else ()
            if len(found):
                places.append(found)
                base.add(label)
        labels, score = set(base), 1.0 if base else 0.0
        at: dict[int, np.ndarray] | None = None
        for t, needed in enumerate(index.needed):
            if not present[needed].all():
                continue
            if at is None:
                order = known[np.argsort(ids[known], kind="stable")]
                words, first = np.unique(ids[order], return_index=True)
                at = dict(zip(words.tolist(), np.split(order, first[1:]), strict=True))
            best = self.coverage(t, ids, at)
            if best:
                labels.add(index.labels[t])
                score = max(score, best)
        every = np.concatenate(places) if places else np.empty(0, np.int64)
        ends = (int(every.min()), int(every.max())) if len(every) else (None, None)
        return len(ids), len(every), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score


def word_weights(documents: DataFrame, index: Index) -> np.ndarray:
    """IDF of the index's words over all documents: log(1 + documents / (1 + holding))."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding: Counter[int] = Counter()
        known = index.number.keys()
        for batch in batches:
            holding[-1] += batch.num_rows
            for text in batch.column(0).to_pylist():
                holding.update(index.number[w] for w in known & set(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(holding.keys(), pa.int32()), pa.array(holding.values(), pa.int64())],
            names=["word", "n"],
        )

    counted = map_batches(documents.select("text"), count, "word int, n long")
    sums = counted.groupBy("word").agg(F.sum("n").alias("n"))
    found = {r.word: r.n for r in sums.collect()}  # a row per word of the templates
    total = found.get(-1, 0)
    holding = np.array([found.get(w, 0) for w in range(len(index.number))], np.float64)
    return np.log1p(max(total, 1) / (1 + holding))


def scanned(documents: DataFrame, index: Index | None = None) -> DataFrame:
    """doc_id and what :meth:`Scanner.scan` finds in every document."""
    index = index or Index()
    scanner = Scanner(index, word_weights(documents, index))
    rows = documents.select("doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    fields = (
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            columns = [
                pa.array([r[i] for r in found], kind_) for i, (_, kind_) in enumerate(fields)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", *(name for name, _ in fields)]
            )

    return map_batches(
        rows,
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double",
    )
