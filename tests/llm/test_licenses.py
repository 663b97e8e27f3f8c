import math
import re

import pytest

from tabscope.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORDS.findall((text or "").translate(LOWER))


def starts(words, phrase):
    n = len(phrase)
    return [i for i in range(len(words) - n + 1) if words[i : i + n] == phrase]


def plain(texts, templates=licenses.TEMPLATES):
    """Every alignment of every template in every text, word by word."""
    docs = [plain_words(t) for t in texts]
    weight = {}
    for t in templates:
        for w in plain_words(t.text):
            weight[w] = math.log1p(len(docs) / (1 + sum(w in d for d in map(set, docs))))
    out = []
    for words in docs:
        places = [i for phrase, _ in licenses.BASE for i in starts(words, phrase.split())]
        base = {label for phrase, label in licenses.BASE if starts(words, phrase.split())}
        labels, score = set(base), 1.0 if base else 0.0
        for t in templates:
            sequence = plain_words(t.text)
            if not all(starts(words, plain_words(p)) for p in t.phrases):
                continue
            n, room = len(sequence), licenses.slack(len(sequence))
            total = sum(weight[w] for w in set(sequence))
            for x in {i - p for p, v in enumerate(sequence) for i, w in enumerate(words) if v == w}:
                hit = {
                    v for p, v in enumerate(sequence)
                    if v in words[max(0, x + p - room) : max(0, x + p + room + 1)]
                }
                share = sum(weight[w] for w in hit) / total
                spans = [
                    any(x - room <= i <= x + n + room - len(plain_words(p)) for i in starts(words, plain_words(p)))
                    for p in t.phrases
                ]
                if all(spans) and share >= licenses.COVERAGE - 1e-9:
                    labels.add(t.label)
                    score = max(score, share)
        out.append((
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), round(min(score, 1.0), 6),
        ))
    return out


def compare(frame):
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    due = [(d, *p) for (d, _), p in zip(rows, plain([t for _, t in rows]), strict=True)]
    made = [(*r[:-1], round(r.score, 6)) for r in licenses.scanned(frame).collect()]
    assert sorted(made, key=repr) == sorted(due, key=repr)
    return {r[0]: r for r in made}


def test_documents(documents):
    made = compare(documents)
    assert {"mit", "apache", "cc-by-nc"} <= {x for r in made.values() for x in r[6].split(",")}


def test_awkward_rows(awkward, nothing):
    compare(awkward)
    assert licenses.scanned(nothing).count() == 0


def changed(text, every=9):
    words = text.split()
    return " ".join(w for i, w in enumerate(words) if i % every != every - 1)


@pytest.mark.parametrize("n", range(len(licenses.TEMPLATES)))
def test_every_template_is_found_in_a_file(n):
    index = licenses.Index()
    scanner = licenses.Scanner(index, licenses.np.ones(len(index.number)))
    template = licenses.TEMPLATES[n]
    commented = "\n".join(f" * {line}" for line in re.findall(r".{1,60}(?: |$)", template.text))
    text = f"/* Copyright 2020 Some Body {commented} */ int main() {{ return 0; }}"
    assert template.label in scanner.scan(text)[5].split(",")


def test_other_wordings(spark):
    mit, _, apache = (t.text for t in licenses.TEMPLATES[:3])
    texts = [
        f"Copyright (c) 2001 Ada L. {mit} THE SOFTWARE IS PROVIDED AS IS",
        " ".join(reversed(mit.split())),  # the same words, elsewhere
        f"{mit[:150]} and then something else entirely was written about a garden",
        mit.replace("software", "programme").replace("Software", "Programme"),
        f"{apache} {'filler ' * 500} {mit}",
        "The MIT License and the mit\nlicense; general public LICENSE",
        "license " * 3000 + "software " * 3000,
        "Licensed under CC BY-NC 4.0.",
        "cc by nc",
    ] + [f"A plain text about number {i} of the software" for i in range(20)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    made = compare(frame)
    assert [made[i][6] for i in range(9)] == ["mit", "", "", "mit", "apache,mit", "gpl,mit", "", "cc-by-nc", ""]
    assert made[5][2:5] == (3, 1, 7)


def test_a_template_must_hold_its_phrases():
    with pytest.raises(ValueError):
        licenses.Index([licenses.Template("x", "one two three", ("two four",))])
