"""URL rules by a blocked Bloom filter and an exact join behind it.

A rule is a canonical URL prefix, ``host/path``, with a verdict; it fits its host and all
subdomains where the URL's path starts with the rule's path. Every canonical URL is taken
apart into the keys a rule could have: each suffix of its host at a dot, with each prefix
of its path that is as long as some rule's path. A blocked Bloom filter of the rules lets
possible hits through: a block has eight 32-bit words and a key sets one bit in each. The
hash join that follows keeps exact hits only, and the longest rule wins.

Equal URLs are judged once. DataFrame functions only.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no
rule; a URL that fits no rule gets the default verdict; equally long rules of one URL are
the same rule, and of repeated rules with different verdicts ``block`` wins; repeated rows
are judged alike; an empty rule list leaves the default everywhere. A listed rule without
a path (no ``/``) is no rule and is left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import measured_bytes, scratch_table, small_side

DEFAULT = "allow"
#: Sixteen bits for each rule: one in some thousand other keys passes.
RULES_A_BLOCK = 16
WORDS = 8
#: Copies of a block and of a rule where they are too many to broadcast.
SALTS = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    lowered = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def _bit(key: Column, word: int) -> Column:
    return F.shiftright(F.xxhash64(key, F.lit(1)), 5 * word).bitwiseAND(F.lit(31)).cast("int")


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the keys ``rule``."""
    key = F.col("rule")
    one = F.lit(1).cast("long")
    masks = [
        F.call_function("shiftleft", one, _bit(key, w)).alias(f"w{w}") for w in range(WORDS)
    ]
    return keys.select(_block(key, blocks), *masks).groupBy("block").agg(
        *[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)]
    )


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every (host suffix, path prefix) key that a rule with such a path length could have."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
        lambda p: p.isNotNull(),
    )
    return F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages(page_id, url)``.

    ``rules(rule, verdict)``. Only their number and the distinct lengths of their paths
    reach the driver.
    """
    listed = scratch_table(
        rules.where("rule is not null and verdict is not null and instr(rule, '/') > 0")
        .groupBy("rule")
        .agg(F.max("verdict").alias("verdict")),
        "url-rules",
    )
    path_length = F.length("rule") - F.instr("rule", "/") + 1
    shape = listed.agg(
        F.count(F.lit(1)).alias("n"), F.collect_set(path_length).alias("lengths")
    ).first()
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not shape.n:
        none = F.lit(None).cast("string").alias("rule")
        return parts.select("*", none, F.lit(default).alias("verdict"))
    blocks = shape.n // RULES_A_BLOCK + 1
    # A key that a third of all URLs have meets its block in several tasks, or in none.
    salts = F.explode(F.array(*map(F.lit, range(SALTS))))
    spread = bloom_blocks(listed, blocks).withColumn("salt", salts)
    bloom = small_side(spread, blocks * SALTS, 104)
    keys = keys_of(F.col("host"), F.col("path"), sorted(shape.lengths))
    key = F.col("key")
    passed = [
        F.call_function("shiftright", F.col(f"w{w}"), _bit(key, w)).bitwiseAND(F.lit(1)) == 1
        for w in range(WORDS)
    ]
    hit = passed[0]
    for p in passed[1:]:
        hit = hit & p
    possible = (
        parts.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(keys).alias("key"))
        .withColumn("block", _block(key, blocks))
        .withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
        .join(bloom, ["block", "salt"])
        .where(hit)
        .select("host", "path", "key", "salt")
    )
    # So does a rule in the exact join.
    salted = listed.withColumn("salt", salts)
    exact = possible.join(
        small_side(salted, SALTS, measured_bytes(listed, "rule", "verdict")),
        (possible["key"] == salted["rule"]) & (possible["salt"] == salted["salt"]),
    )
    best = exact.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("length"), "rule", "verdict")).alias("best")
    )
    return parts.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
