import math

import numpy as np

from tabscope.llm import cotraining as ct


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = ct.score_documents(documents, labels)
    assert scored.count() == documents.count()
    both = scored.where("held_out").join(labels, "doc_id").collect()
    good = [r.kept for r in both if r.quality == 1]
    bad = [r.kept for r in both if r.quality == 0]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / len(bad) < 0.3
    assert all(0 <= s <= 1 for r in both for s in (r.score, r.text_score, r.metadata_score))


def test_reruns_agree(documents, labels):
    one, two = (
        sorted(map(tuple, ct.score_documents(documents, labels).collect())) for _ in range(2)
    )
    assert one == two


def test_awkward_rows(spark, awkward, nothing, labels):
    some = spark.createDataFrame(
        [(i, i % 2) for i in range(1, 11)] + [(1, None), (None, 1), (99, 0)],
        "doc_id long, quality int",
    )
    scored = ct.score_documents(awkward, some).collect()
    assert len(scored) == awkward.count() and all(0 <= r.score <= 1 for r in scored)
    assert {r.score for r in ct.score_documents(awkward, some.where("false")).collect()} == {0.5}
    assert ct.score_documents(nothing, labels).count() == 0


def test_views_hand_on_what_they_are_sure_of(spark, monkeypatch):
    """The metadata view learns from the text view: its own labels say nothing of source b."""
    rows, marks = [], []
    for i in range(3000):
        bad = i % 3 == 0
        text = " ".join(["noise$$$" if bad else "plain"] * 12 + [f"w{i}"])
        rows.append((i, text, "en", "bad" if bad else "good", len(text)))
        if i < 200:
            marks.append((i, int(not bad)))
    documents = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    scored = ct.score_documents(documents, labels).collect()
    assert all(r.kept == bool(r.doc_id % 3) for r in scored)


def test_every_unlabelled_document_takes_part(spark, documents, labels):
    """Pseudo-labels grow with the corpus, and slices cover all of it."""
    handed = []
    for times in (1, 4):
        more = documents
        for i in range(1, times):
            more = more.unionAll(documents.withColumn("doc_id", documents.doc_id + i * 1_000_000))
        rows = ct.features(more, labels)
        slices = [r["count"] for r in rows.where("label is null").groupBy("slice").count().collect()]
        assert len(slices) == ct.ROUNDS
        assert sum(slices) == more.count() - rows.where("label is not null").count()
        handed.append(sum(map(sum, ct.train(rows).handed)))
    assert handed[1] > 3.5 * handed[0] > 0


def plain_discriminant(x, y, w):
    """Class means and pooled covariance, row by row."""
    means = [np.average(x[y == k], axis=0, weights=w[y == k]) for k in (0, 1)]
    off = x - np.array(means)[y]
    spread = (off * w[:, None]).T @ off / w.sum()
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-8))
    shape = spread / np.outer(scale, scale) + ct.RIDGE * np.eye(x.shape[1])
    weights = np.linalg.solve(shape, (means[1] - means[0]) / scale) / scale
    return x @ weights - weights @ (means[0] + means[1]) / 2


def test_a_discriminant_from_sums_is_that_of_the_rows():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    x = rng.standard_normal((300, 6)) + y[:, None] * np.arange(6) / 3
    w = rng.uniform(0.9, 1.0, 300)
    parts = [np.concatenate([ct.moments(x[i::3], np.where(y == k, w, 0)[i::3]) for k in (0, 1)]) for i in range(3)]
    made = ct.Discriminant.fit(sum(parts), 6)
    np.testing.assert_allclose(made(x), plain_discriminant(x, y, w), rtol=1e-6, atol=1e-6)


def test_the_first_views_are_fitted_on_all_labels(documents, labels, monkeypatch):
    """Sums and log-odds against plain ones over the feature rows."""
    rows = ct.features(documents, labels)
    used = rows.where("label is not null and not calibrates")
    sums, groups = ct.gather(used, None)
    table = used.toPandas()
    x = np.array([np.frombuffer(c, np.float32) for c in table.content], np.float64)
    y = table.label.to_numpy()
    made = ct.Discriminant.fit(sums[: ct._SIZES[0]], ct.TEXT_WIDTH)
    np.testing.assert_allclose(made(x), plain_discriminant(x, y, np.ones(len(y))), rtol=1e-5, atol=1e-5)
    odds = {(r.kind, r.value): r.llr for r in ct.log_odds(groups).collect()}
    for kind in ("lang", "source"):
        values = table[kind].unique()
        for value in values:
            mine = table[kind] == value
            w = [(mine & (y == k)).sum() for k in (0, 1)]
            t = [(y == k).sum() for k in (0, 1)]
            common = (sum(w) + 1) / (sum(t) + len(values))
            due = math.log(((w[1] + ct.PRIOR * common) / (t[1] + ct.PRIOR)) / ((w[0] + ct.PRIOR * common) / (t[0] + ct.PRIOR)))
            assert abs(odds[kind, value] - due) < 1e-6
    monkeypatch.setattr(ct, "PARTS", 0)
    again, _ = ct.gather(used.repartition(7, "doc_id"), None)
    np.testing.assert_allclose(again, sums, rtol=1e-9, atol=1e-9)


def test_exchange_against_single_views(spark):
    """Held-out accuracy of one view, of both, and without exchange."""
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = ct.features(documents, labels)
    truth = labels.groupBy("doc_id").agg({"quality": "min"}).withColumnRenamed("min(quality)", "quality")
    made = ct.scored(rows, ct.train(rows))
    held = made.where(ct.held_out(made.doc_id)).join(truth, "doc_id").toPandas()
    right = {c: ((held[c] >= 0.5) == (held.quality == 1)).mean() for c in ("text_score", "metadata_score", "score")}
    assert right["score"] > 0.97 and right["text_score"] > 0.95
    assert right["score"] >= max(right["text_score"], right["metadata_score"]) - 0.005
