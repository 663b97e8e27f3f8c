"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.session import ensure_checkpoint_dir

#: Rounds are logarithmic in the longest chain; this only guards against a bug.
MAX_ROUNDS = 60


def _min_neighbour(pairs: DataFrame) -> DataFrame:
    """Smallest of a node and its neighbours; combines on the map side."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_min_neighbour(both), "u")
        .where("v > u and v > m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where("u > v")
    least = _min_neighbour(down)
    linked = down.join(least, "u").where("v > m")
    linked = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionAll(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``; the root is the smallest node.

    A node never meets all its neighbours in one task: minima combine on the map side,
    and the join that hands them back is one that adaptive execution splits. Every
    round is checkpointed. Loops and repeated or empty links are fine.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = (
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u > v")
        .distinct()
        .checkpoint()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        edges = _small_star(_large_star(edges)).distinct().checkpoint()
        now = edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v") % 1_000_003),
            F.sum(F.crc32(F.concat_ws(",", "u", "v"))),
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionAll(own)
