"""A corpus pipeline: stages over the documents table, each written before the next reads.

Rows that go: toxic documents, all but one of each near-duplicate group, documents that
hold a benchmark passage, documents the mix leaves out. The mix repeats documents of
sources it needs more than once. The last stage writes token files and returns what they
hold of every document.

Defined results: null, empty and wordless texts are scored like a text without words, are
near-duplicates of each other, hold no benchmark item, have the size 0 and so are in no mix;
null ids, languages and sources are values of their own; repeated rows are near-duplicates;
of documents that could stay for each other the one with the smallest id does, then the
first by a hash of its values, so that two runs over the same documents keep the same rows;
an empty table stays empty. Columns a stage does not know pass through, also when they are
named like one of its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabscope.llm import decontamination, mixing, simhash, tokenfiles, toxicity
from tabscope.llm.common import scratch_table, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenfiles.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: Language models and tokenizers are not SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is a Parquet table the next reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
