"""Ordering helpers that stay distributed.

``row_number() OVER (ORDER BY ...)`` without a partition moves every row into one task.
``global_row_number`` range-partitions instead, numbers rows inside each partition with
``monotonically_increasing_id`` and adds per-partition offsets computed from a table with
one row per partition (a proven size bound, so it is broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

_LOCAL_BITS = 33


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_no",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in ``order``, computed without a single-task sort."""
    # without an explicit count AQE may coalesce the range partitions (contiguous ranges)
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    ordered = (ranged.sortWithinPartitions(*order)
               .withColumn("_mid", F.monotonically_increasing_id()))
    # range bounds are sampled and ids depend on partitioning: freeze both
    ordered = cut_lineage(ordered)
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = ordered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ordered.withColumn("_pid", pid)
            .join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + local + F.lit(1)).cast("long"))
            .drop("_pid", "_off", "_mid"))


def top_per_series(df: DataFrame, k: int, score: Column, keys: Sequence[str] = (),
                   name: str = "rank") -> DataFrame:
    """Top ``k`` rows per series by ``score`` (descending).

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before the shuffle,
    so a hot series ships at most k rows per task.
    """
    w = Window.partitionBy(*keys, "metric").orderBy(score.desc(), F.col("timestamp"))
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
