"""Connected components of an edge table, as staged large-star / small-star rounds.

Neither edges nor labels leave the executors; each round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillpoint.llm.common import stage

MAX_ROUNDS = 60


def _staged_with_sum(edges: DataFrame) -> tuple[DataFrame, tuple]:
    obs = Observation()
    seen = edges.observe(obs, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
    out = stage(seen)
    return out, (obs.get["n"], obs.get["x"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return both.join(least, both["a"] == least["k"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
    moved = down.join(least, down["a"] == least["k"]).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root) for every node that has an edge, but for the roots
    themselves; root is the smallest node of the component."""
    e, last = _staged_with_sum(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(MAX_ROUNDS):
        if not last[0]:
            break
        e, now = _staged_with_sum(_small_star(_large_star(e)))
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
