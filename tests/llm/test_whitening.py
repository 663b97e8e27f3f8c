import numpy as np
import pytest

from tabscope.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n long, block string"


def frame(spark, vectors):
    rows = [(i, v, 7, 8, "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(vectors):
    """Ids, integer rows and the exact figures of the vectors that can be used."""
    kept = [
        (i, np.array(v, np.float64))
        for i, v in enumerate(vectors)
        if v is not None and all(e is not None and np.isfinite(e) for e in v)
    ]
    x = np.array([np.floor(64 * v.astype(np.float32).astype(float)) for _, v in kept]).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    deviation = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
    return [i for i, _ in kept], x, n, sums, values[::-1], vectors_[:, ::-1], deviation


def compare(spark, vectors, tolerance=1e-6):
    ids, x, n, sums, values, axes, deviation = plain(vectors)
    made = whitening.whitened(frame(spark, vectors)).toPandas()
    k = min(16, x.shape[1])
    assert len(made) == len(ids) * k
    assert set(made.n) == {n}
    made = made.sort_values(["vec_id", "component"])
    assert made.vec_id.tolist() == np.repeat(ids, k).tolist()
    assert made.component.tolist() == list(range(1, k + 1)) * len(ids)
    assert made.deviation.tolist() == np.repeat(deviation, k).tolist()
    live = values[:k] > values.sum() * 1e-13
    due = ((n * x - sums) / n) @ axes[:, :k] / np.sqrt(np.where(live, values[:k], 1))
    got = made.whitened.to_numpy().reshape(len(ids), k)
    for c in range(k):
        if not live[c]:
            assert np.isnan(got[:, c]).all()
            continue
        sign = np.sign((due[:, c] * got[:, c]).sum())
        np.testing.assert_allclose(sign * got[:, c], due[:, c], atol=tolerance)
    share = made.explained.to_numpy().reshape(len(ids), k)[0]
    np.testing.assert_allclose(share, np.where(live, values[:k] / values.sum(), 0), rtol=1e-9, atol=1e-13)
    assert made.identity_error.nunique() == 1
    assert made.identity_error.iloc[0] <= 1e-9
    return made


def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id")
    compare(spark, [r.embedding for r in table.collect()])


@pytest.mark.parametrize("decay", [0.5, 0.9, 1.0])
def test_steep_and_flat_spectra(spark, decay):
    rng = np.random.default_rng(3)
    scale = 40 * decay ** np.arange(50)
    compare(spark, (rng.standard_normal((400, 50)) * scale).tolist())


def test_awkward_rows(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((60, 20)).tolist()
    odd = [None, [None] * 20, [float("nan")] * 20, [float("inf")] + [0.0] * 19]
    compare(spark, [good[0], *odd, good[0], good[1], good[1], *good])


def test_other_lengths_and_empty_tables(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((30, 5)).tolist()
    made = whitening.whitened(frame(spark, [*good, [1.0, 2.0], []]))
    assert made.select("vec_id").distinct().count() == 30
    assert whitening.whitened(frame(spark, good).where("false")).count() == 0
    assert whitening.whitened(frame(spark, [None, []])).count() == 0


def test_no_variance(spark):
    made = whitening.whitened(frame(spark, [[0.5, 0.25, -1.0]] * 4)).collect()
    assert len(made) == 12
    assert {(r.n, r.deviation, r.whitened, r.explained) for r in made} == {(1, 0, None, 0.0)}
    flat = [[float(i % 7), 3.0, float(i % 5)] for i in range(40)]
    compare(spark, flat)


def test_large_entries(spark):
    """Beyond 64 bits a deviation is null; sums stay exact."""
    vectors = [[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0], [0.0, 4.0]]
    made = whitening.whitened(frame(spark, vectors)).collect()
    assert len(made) == 8 and {r.deviation for r in made if r.vec_id == 0} == {None}
    middle = whitening.Centre(4, [2**62, 5])
    assert middle.deviations(np.array([[2**60, 1], [2**60 + 1, 2]])).to_pylist() == [1, 25]


def test_sums_of_many_tasks_are_added_on_the_executors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PARTS", 2)
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 256)
    rng = np.random.default_rng(6)
    compare(spark, rng.standard_normal((200, 24)).tolist())


def test_rounding_decides_what_certifies(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    usable = whitening.finite(table, "vec_id", "embedding")
    model = whitening.principal(whitening.fit_blocks(usable, 64), 64)
    assert model.passes < 80
    np.testing.assert_allclose(model.vectors.T @ model.vectors, np.eye(16), atol=1e-13)
