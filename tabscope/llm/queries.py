"""The registered queries of this subpackage: thin calls over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabscope.llm import (
    collocations,
    cotraining,
    decontamination,
    licenses,
    mixing,
    qualityrules,
    simhash,
    tokencount,
    tokenfiles,
    toxicity,
    urlfilter,
    warc,
    whitening,
)
from tabscope.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokenfiles.token_files(table(spark, sf_dir, "documents"), path)


def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


#: Verdict, host and path of the contract's rules.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [(verdict, host + path) for verdict, host, path in URL_RULES]
    listed = spark.createDataFrame(rules, "verdict string, rule string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), listed)


URL_SQL = f"""
WITH rule(verdict, host, path) AS (VALUES {", ".join(map(str, URL_RULES))}),
rest AS (
  SELECT page_id, row_number() OVER () AS nr,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS url
  FROM pages
),
cut AS (SELECT page_id, nr, url, regexp_extract(url, '^[^/?#]*') AS host FROM rest),
part AS (
  SELECT page_id, nr,
    coalesce(translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(substr(url, length(host) + 1), '^[^?#]*'), '') AS path
  FROM cut
),
best AS (
  SELECT part.nr, arg_max(rule.host || rule.path, length(rule.host || rule.path)) AS rule,
    arg_max(rule.verdict, length(rule.host || rule.path)) AS verdict
  FROM part JOIN rule
    ON (part.host = rule.host OR ends_with(part.host, '.' || rule.host))
    AND starts_with(part.path, rule.path)
  GROUP BY part.nr
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM part LEFT JOIN best USING (nr)
"""


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.judged(table(spark, sf_dir, "documents"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return tokencount.token_counts(table(spark, sf_dir, "documents"), path)


def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def collocation_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


COLLOCATION_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM piece
),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
gram AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM words, (VALUES (1), (2), (3), (4)) AS sizes(size)
  )
),
f AS (
  SELECT lang, size, phrase, count(*) AS f FROM gram GROUP BY lang, size, phrase HAVING count(*) >= 30
),
cut AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
  FROM f WHERE size > 1
),
sized AS (
  SELECT cut.lang, cut.phrase, cut.a, cut.k, x.f AS l, y.f AS r,
    (2000000 * cut.a::HUGEINT // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cut
  JOIN f AS x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1:cut.k], ' ')
  JOIN f AS y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[cut.k + 1:], ' ')
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nr FROM sized
),
inside AS (
  SELECT lang, f, array_to_string(w[i:i + part - 1], ' ') AS phrase
  FROM (
    SELECT lang, f, w, part, unnest(range(1, size - part + 2)) AS i
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS part FROM f WHERE size > 2)
  )
),
longer AS (SELECT lang, phrase, max(f) AS longer FROM inside GROUP BY lang, phrase),
kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase)
  WHERE nr = 1 AND coalesce(100 * longer::HUGEINT < 80 * a::HUGEINT, true)
),
placed AS (
  SELECT lang, row_number() OVER (
      PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN total USING (lang) WHERE rank <= 2000
"""


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_benchmark_leaks": benchmark_leaks,
        "op2_cotrained_quality": cotrained_quality,
        "op3_simhash_near_duplicates": simhash_near_duplicates,
        "op4_curriculum_mix": curriculum_mix,
        "op5_warc_round_trip": warc_round_trip,
        "op6_toxicity": toxicity_scores,
        "op7_token_files": token_files,
        "op8_url_verdicts": url_verdicts,
        "op9_quality_rules": quality_rules,
        "op10_token_counts": token_counts,
        "op11_whitened_embeddings": whitened_embeddings,
        "op12_collocations": collocation_ranks,
        "op13_license_scan": license_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_url_verdicts": URL_SQL, "op12_collocations": COLLOCATION_SQL}
