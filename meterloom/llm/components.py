"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.shared import checkpointed

LINKS_A_TASK = 4096
LEAST_TASKS = 8


def _either(one: Column, other: Column, df: DataFrame) -> DataFrame:
    """Both pairs ``u``, ``v`` of every row."""
    return df.select(F.explode(F.array(one, other)).alias("pair")).select("pair.u", "pair.v")


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id that links reach) of all that is linked.

    ``links``: bigint ``a`` and ``b``, in any order, repeated or not; rows with a null or
    of an id with itself link nothing. A large star hangs every larger neighbour of a node
    on the smallest one, a small star the smaller ones; the links that remain are stars
    around the smallest ids after few rounds (their number grows with the logarithm of the
    longest path). Minima are combined before the shuffle; no neighbourhood is gathered.
    Each round is cut off by a checkpoint, and the driver sees only two sums of it. A round
    reads its links once for both directions, and leaves them in as many partitions as they
    need: the driver keeps something of every task.
    """
    ends = links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).filter("a is not null and b is not null and a <> b")
    edges = checkpointed(ends.distinct())
    seen = None
    while True:
        both = _either(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")), edges)
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = (
            both.join(lowest, "u")
            .filter("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lowest, "u")
        near = F.struct("u", F.col("m").alias("v"))
        far = F.when(F.col("v") != F.col("m"), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = _either(near, far, hung).filter("u is not null").distinct()
        if seen:
            small = small.coalesce(LEAST_TASKS + seen[0] // LINKS_A_TASK)
        edges = checkpointed(small)
        mark = edges.agg(
            F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))
        ).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
