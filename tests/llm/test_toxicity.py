import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabscope.llm import toxicity


def test_scores_of_every_row(awkward, labels, documents):
    scored = toxicity.score_documents(documents, labels).collect()
    assert len(scored) == documents.count()
    assert all(0 <= r.score <= 1 for r in scored)
    assert all(r.predicted == (r.score >= 0.3) for r in scored)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)


def test_insults_are_learned_and_clean_documents_stay(spark):
    calm = "the river runs along the old town and people walk there in the evening"
    texts, marks = [], []
    for i in range(400):
        insult = i % 5 == 0
        text = " ".join((calm + f" number{i % 37}").split()[:: 1 if i % 2 else -1])
        texts.append((i, text + (" you lowlife scumbag" if insult else " good friend")))
        marks.append((i, int(insult)))
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    scored = toxicity.score_documents(documents, labels).where("held_out").collect()
    assert {r.doc_id for r in scored if r.predicted} == {r.doc_id for r in scored if r.doc_id % 5 == 0}
    kept = toxicity.without_toxic(documents, labels)
    assert {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 5}


def test_awkward_rows(awkward, labels, spark):
    some = spark.createDataFrame(
        [(1, 0), (1, 1), (2, 0), (3, 1), (3, None), (None, 1), (77, 1), (6, 0)],
        "doc_id long, toxic int",
    )
    scored = toxicity.score_documents(awkward, some).collect()
    assert len(scored) == awkward.count()
    assert all(0 <= r.score <= 1 for r in scored)
    kept = toxicity.without_toxic(awkward, some)
    assert kept.columns == awkward.columns


def test_without_labels_and_without_documents(awkward, nothing, labels):
    none = labels.where("false")
    assert {r.score for r in toxicity.score_documents(awkward, none).collect()} == {0.0}
    assert toxicity.without_toxic(awkward, none).count() == awkward.count()
    assert toxicity.score_documents(nothing, labels).count() == 0


WORDS = re.compile(r"[^\W_]+")


def plain_model(rows):
    """Ratios of every stem, word and pair of (text, label) by the formulas, in dictionaries."""
    c = [Counter(), Counter()]
    pairs = [Counter(), Counter()]
    for text, label in rows:
        words = WORDS.findall((text or "").lower())
        c[label].update(words)
        pairs[label].update(zip(words, words[1:]))
    d = toxicity.DISCOUNT
    total = [sum(x.values()) for x in c]
    types = [len(x) for x in c]
    every = set(c[0]) | set(c[1])
    k = [Counter(w[:4] for w in x) for x in c]
    stems = {w[:4] for w in every}
    tokens = Counter()
    for x in c:
        for w, n in x.items():
            tokens[w[:4]] += n
    below = d * (len(k[0]) + len(k[1])) / sum(types)
    q = {
        s: [max(k[i][s] - d, 0) / types[i] + below * (k[0][s] + k[1][s] + 1) / (sum(types) + len(stems) + 1) for i in (0, 1)]
        for s in stems
    }
    freed = d * sum(types) / sum(total)
    p = {
        w: [
            max(c[i][w] - d, 0) / total[i] + freed * q[w[:4]][i] * (c[0][w] + c[1][w] + 0.5) / (tokens[w[:4]] + 1)
            for i in (0, 1)
        ]
        for w in every
    }
    context = [Counter(), Counter()]
    follow = [Counter(), Counter()]
    for i in (0, 1):
        for (u, _), n in pairs[i].items():
            context[i][u] += n
            follow[i][u] += 1
    log = lambda x: math.log(x[1] / x[0])
    stem = {s: log(x) for s, x in q.items()}
    word = {w: log(x) for w, x in p.items()}
    pair = {}
    for u, v in set(pairs[0]) | set(pairs[1]):
        weight = d * (follow[0][u] + follow[1][u]) / (context[0][u] + context[1][u])
        both = [
            max(pairs[i][u, v] - d, 0) / context[i][u] + weight * p[v][i] if context[i][u] else p[v][i]
            for i in (0, 1)
        ]
        pair[u, v] = log(both)
    counts = lambda x, i: x[0][i] + x[1][i]
    kept_words = {w: r for w, r in word.items() if counts(c, w) * abs(r - stem[w[:4]]) >= toxicity.WORD_GAIN}
    kept_pairs = {
        uv: r
        for uv, r in pair.items()
        if counts(pairs, uv) >= toxicity.LEAST_PAIRS and counts(pairs, uv) * abs(r - word[uv[1]]) >= toxicity.PAIR_GAIN
    }
    return stem, kept_words, kept_pairs


def signed(word):
    h = toxicity._hash(word)
    return h - (1 << 64) if h >> 63 else h


@pytest.mark.parametrize("run, bucket", [(4_000_000, 32 << 20), (300, 2000)])
def test_ratios_are_those_of_the_formulas(documents, labels, spark, monkeypatch, run, bucket):
    monkeypatch.setattr(toxicity, "RUN_WORDS", run)
    monkeypatch.setattr(toxicity, "BUCKET_BYTES", bucket)
    known = toxicity.training_labels(labels)
    rows = toxicity.labelled(documents, known, known.count())
    texts = [tuple(r) for r in rows.collect()]
    stem, word, pair = plain_model(texts)
    made = [t.collect() for t in toxicity.ratios(toxicity.counted(rows))]
    assert {r.key: r.ratio for r in made[0]} == pytest.approx({signed(s): r for s, r in stem.items()})
    assert {r.key: r.ratio for r in made[1]} == pytest.approx({signed(w): r for w, r in word.items()})
    assert {(r.a, r.word): r.ratio for r in made[2]} == pytest.approx(
        {(signed(u), signed(v)): r for (u, v), r in pair.items()}
    )


def test_word_order_is_seen(spark):
    """An expression of ordinary words is toxic in one order only."""
    rng = random.Random(3)
    filler = "we walk along a river today and people smile at us".split()
    texts, marks = [], []
    for i in range(800):
        words = [rng.choice(filler) for _ in range(30)]
        toxic = i % 4 == 1
        at = rng.randrange(30)
        words[at:at] = ["get", "lost"] if toxic else ["lost", "get"]
        texts.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    scored = toxicity.score_documents(documents, labels).where("held_out").collect()
    assert all(r.predicted == (r.doc_id % 4 == 1) for r in scored) and len(scored) > 100


def test_unseen_words_say_nothing(spark):
    rows = [("calm calm river river river boat", 0)] * 9 + [("scum scum scum river boat boat", 1)] * 2
    frame = spark.createDataFrame(rows, "_text string, _label int")
    stems, words, _ = ({r[0]: r.ratio for r in t.collect()} for t in toxicity.ratios(toxicity.counted(frame)))
    of = lambda table: toxicity.Table.of(np.array(list(table), np.int64).view(np.uint64), np.array(list(table.values())))
    model = toxicity.Ratios(of(stems), of(words), of({}))
    unseen, scum, calm, scummy = model(toxicity._keys("zebra scum calm scumminess"))
    assert scum > 1 and calm < -1
    assert unseen == 0
    assert scummy > 0  # its stem continues a toxic word only


def test_counts_are_exact_beyond_any_table(spark):
    frame = spark.range(3000).selectExpr("concat('w', id, ' x', id % 50, ' w', id) AS _text", "int(id % 2) AS _label")
    rows = toxicity.counted(frame).where("kind = 0").groupBy("a").agg({"c0": "sum", "c1": "sum"}).collect()
    assert len(rows) == 3050 and sum(r[1] + r[2] for r in rows) == 9000


def test_held_out_documents_of_the_test_tables(spark):
    root = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{root}/labels.parquet")
    scored = toxicity.score_documents(spark.read.parquet(f"{root}/documents.parquet"), labels)
    marks = labels.groupBy("doc_id").agg({"toxic": "max"}).withColumnRenamed("max(toxic)", "toxic")
    rows = scored.where("held_out").join(marks, "doc_id").collect()
    toxic = [r for r in rows if r.toxic]
    found = sum(r.predicted for r in toxic)
    assert found >= 0.9 * len(toxic)
    assert found >= 0.8 * sum(r.predicted for r in rows)


ODD_TEXTS = [
    None, "", " ", "ÄÖ_ß x1²  ǅ İstanbul ΣΑΣ Σ", "日本語 テスト a_b__c", "😀a😀", "½a ٣ é éx", "_", "a",
    "x" * 300 + " " + "é" * 9 + " " + "y" * 16, "\x00b\x1fc", "ﬁne ªº calm", "scum, scum! calm scumminess", "",
]


def test_words_and_stems_of_many_texts_are_found_at_once():
    keys, bounds = toxicity._words(ODD_TEXTS)
    for i, text in enumerate(ODD_TEXTS):
        words = WORDS.findall((text or "").lower())
        want = [(toxicity._hash(w), toxicity._hash(w[:4])) for w in words]
        assert [tuple(k) for k in keys[bounds[i] : bounds[i + 1]].tolist()] == want
    every = {w for t in ODD_TEXTS for w in WORDS.findall((t or "").lower())}
    assert len({toxicity._hash(w) for w in every}) == len(every)


@pytest.mark.parametrize("run", [1, 40, 1 << 20])
def test_many_texts_are_looked_up_at_once(monkeypatch, run):
    monkeypatch.setattr(toxicity, "RUN_CHARACTERS", run)
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["calm", "river", "scum", "é", "boat"], n)) for n in range(40)] + ODD_TEXTS
    keys = [toxicity._keys(t) for t in texts]
    every = np.concatenate(keys)
    of = lambda k: toxicity.Table.of(np.unique(k), rng.normal(size=len(np.unique(k))))
    model = toxicity.Ratios(of(every[:, 1]), of(every[:200, 0]), of(toxicity._pairs(keys[30][:, 0])[1:]))
    want = [model(k).tolist() for k in keys]
    calls = []
    look_up = toxicity.Table.__call__
    monkeypatch.setattr(toxicity.Table, "__call__", lambda *a: calls.append(1) or look_up(*a))
    assert [r.tolist() for r in model.of_texts(texts)] == want
    assert run < 1 << 20 or len(calls) == 3
