"""Rolling statistics for very long series by halo chunks.

A trailing frame of w rows only needs the w-1 rows before it. Give every row its position
within its series, cut series into chunks of B rows (B >= w-1) and copy the last w-1 rows
of each chunk into the next one as a halo. Windows then partition by (series, chunk), so a
single huge series is spread over many tasks; halo rows only feed frames and are dropped.

Positions come from a range-partitioned sort: per (partition, series) row counts (a table
bounded by partitions + series) give each series' offset in every partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import safe_ratio
from ..options import DetectOptions
from ..session import cut_lineage
from .rolling import rolling_columns

_LOCAL_BITS = 33


def series_positions(long: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
                     tiebreak: Sequence[str] = (), num_partitions: int | None = None,
                     name: str = "pos") -> DataFrame:
    """0-based position of each row inside its series, without a per-series task."""
    sk = [*keys, "metric"]
    order = [*sk, ts, *tiebreak]
    # without an explicit count AQE may coalesce the range partitions; coalesced partitions
    # are contiguous ranges, so partition ids still follow the sort order
    ranged = (long.repartitionByRange(num_partitions, *order) if num_partitions
              else long.repartitionByRange(*order))
    ranged = (ranged.sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)  # freeze sampled bounds and ids before two passes
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    counts = ranged.groupBy(*sk, "_pid").agg(F.count(F.lit(1)).alias("_n"),
                                             F.min("_mid").alias("_first"))
    before = Window.partitionBy(*sk).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (ranged.join(offsets.select(*sk, "_pid", "_off", "_first"), [*sk, "_pid"])
            .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first"))
            .drop("_mid", "_pid", "_off", "_first"))


def halo_rolling_stats(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                       ts: str = "ts", value: str = "value", tiebreak: Sequence[str] = ()
                       ) -> DataFrame:
    """Same columns and values as ``rolling_stats``, computed chunk by chunk."""
    opts = options.validated()
    chunk = int(opts.chunk_rows)
    halo = opts.window_size - 1
    pos = series_positions(long, keys, ts, tiebreak)
    home = F.floor(F.col("pos") / F.lit(chunk)).cast("long")
    in_tail = (F.col("pos") % F.lit(chunk)) >= F.lit(chunk - halo)
    copies = F.when(in_tail & F.lit(halo > 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = (pos.withColumn("_home", home)
              .withColumn("_shift", F.explode(copies))
              .withColumn("_chunk", F.col("_home") + F.col("_shift")))
    cols = rolling_columns(F.col(value), opts.window_size, opts.periods, keys, ["pos"],
                           extra_partition=["_chunk"])
    scored = spread.withColumns(cols).filter(F.col("_shift") == 0)
    scored = scored.withColumn("z", safe_ratio(F.col(value) - F.col("rolling_mean"),
                                               F.col("rolling_std")))
    return scored.drop("_home", "_shift", "_chunk")
