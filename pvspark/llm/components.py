"""Connected components by distributed union-find on stars.

Every round links each node's larger neighbours to the smallest (large star), then each node and its
smaller neighbours to the smallest (small star).  Components stay connected, and after a number of
rounds that grows with the logarithm of their size every node hangs on its component's smallest node.

Rounds are aggregates and joins of the link table only.  Each is written to the shared folder, so a
lost executor costs at most one round, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pvspark.llm.scratch import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.least(F.min("low"), F.first("node")).alias("least"))
    larger = both.filter(F.col("low") > F.col("node"))
    return (
        larger.join(least, "node")
        .select(F.col("low").alias("node"), F.col("least").alias("low"))
        .filter(F.col("node") != F.col("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("node").agg(F.min("low").alias("least"))
    moved = links.join(least, "node").select(F.col("low").alias("node"), F.col("least").alias("low"))
    kept = least.select("node", F.col("least").alias("low"))
    return moved.unionByName(kept).filter(F.col("node") != F.col("low")).distinct()


def _mark(links: DataFrame):
    return links.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node", "low")).alias("sum")
    ).first()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node that has a link.

    ``links`` has two columns of one sortable type, in any direction, with repeats and self-links; rows
    with a null are ignored.  No links give an empty result.
    """
    left, right = links.columns
    now = written(
        links.select(F.greatest(left, right).alias("node"), F.least(left, right).alias("low"))
        .filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("node") != F.col("low")))
        .distinct(),
        "links",
    )
    mark = _mark(now)
    for _ in range(rounds):
        following = written(_small_star(_large_star(now)), "links")
        next_mark = _mark(following)
        now = following
        if next_mark == mark:
            break
        mark = next_mark
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return now.select("node", F.col("low").alias("component")).unionByName(roots)
