"""The pipeline against plain versions of its stages, each fed what the one before kept."""

from collections import Counter

import corpus_pipeline as cp
from tabscope.llm import decontamination, mixing, toxicity
from tabscope.llm.common import scratch_table
from tests.conftest import SMALL
from tests.llm.test_simhash import plain as components
from tests.llm.test_tokenfiles import plain as tokens


def ids(frame):
    return Counter(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_in_order(spark, documents, labels):
    assert [name for name, _ in cp.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "mixing", "token_files",
    ]
    docs = documents
    for name, stage in cp.STAGES[:-1]:
        made = scratch_table(stage(spark, docs, SMALL), name)
        assert made.columns == documents.columns
        if name == "toxicity":
            scores = toxicity.score_documents(docs, labels)
            assert ids(made) == ids(scores.where("predicted = 0"))
        elif name == "near_duplicates":
            pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
            assert ids(made) == Counter({c for _, _, c in components(pairs)})
        elif name == "decontamination":
            items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            gone = {r.doc_id for r in decontamination.contaminated(docs, items).collect()}
            assert ids(made) == Counter({d: n for d, n in ids(docs).items() if d not in gone})
        else:
            taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
            size = {r.doc_id: r.size for r in mixing.mix(docs).collect()}
            assert all(n * size[d] == taken[d] for d, n in ids(made).items())
        docs = made
    result = cp.STAGES[-1][1](spark, docs, SMALL)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in result.collect()), key=repr)
    assert got == tokens(docs)


def test_run(spark):
    made = cp.run(spark, SMALL)
    assert made.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert made.count() > 0


def test_awkward_documents(spark, awkward):
    docs = awkward
    for _, stage in cp.STAGES:
        docs = scratch_table(stage(spark, docs, SMALL), "awkward")
    assert docs.count() > 0


def test_no_documents(spark, nothing):
    docs = nothing
    for _, stage in cp.STAGES:
        docs = scratch_table(stage(spark, docs, SMALL), "nothing")
    assert docs.count() == 0
