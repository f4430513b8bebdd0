"""Rolling statistics over large windows: a frame is two look-ups.

Spark evaluates a sliding frame anew for each row, so a window of w rows costs w steps a row. Here
each series is cut into blocks of w rows. A frame of w rows ends in one block and begins in the one
before: its moments are those from the start of the row's block to the row (a growing frame, one step
a row), merged with those from the frame's first row to the end of its block (a growing frame in the
other direction, read w - 1 rows back). Count, mean and sum of squared deviations merge pairwise
(Chan et al.), which keeps its precision for values far from zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import safe_ratio
from ..options import DetectOptions

#: Windows of more rows than this take blocks in ``rolling_stats``.
LARGE_WINDOW = 256


def _moments(value: Column, window) -> Column:
    n = F.count(value).over(window)
    return F.struct(n.alias("n"), F.avg(value).over(window).alias("mean"),
                    (F.var_pop(value).over(window) * n).alias("m2"),
                    F.min(value).over(window).alias("low"), F.max(value).over(window).alias("high"))


def blocked_rolling_stats(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                          ts: str = "ts", value: str = "value", tiebreak: Sequence[str] = (),
                          extra_partition: Sequence[str] = ()) -> DataFrame:
    """The columns of ``rolling_stats``, equal to rounding, at a cost that does not grow with the
    window. All windows share the series' one shuffle."""
    opts = options.validated()
    w, v = opts.window_size, F.col(value)
    sk = [*keys, "metric", *extra_partition]
    series = Window.partitionBy(*sk).orderBy(ts, *tiebreak)
    block = Window.partitionBy(*sk, "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = long.withColumn("_pos", F.row_number().over(series) - 1)
    placed = placed.withColumn("_block", F.floor(F.col("_pos") / w))
    placed = placed.withColumn("_rest", _moments(v, block.orderBy(F.col("_pos").desc())))
    placed = placed.withColumn("_head", _moments(v, block.orderBy("_pos")))
    # the frame's first row lies w - 1 rows back; it is in this block only for the block's last row
    tail = F.lag("_rest", w - 1).over(Window.partitionBy(*sk).orderBy("_pos"))
    placed = placed.withColumn("_tail", F.when(F.col("_pos") % w != w - 1, tail))
    a, b = F.col("_tail"), F.col("_head")
    na, nb = F.coalesce(a["n"], F.lit(0)), b["n"]
    n = na + nb
    apart = b["mean"] - a["mean"]
    both = (na > 0) & (nb > 0)
    mean = F.when(both, a["mean"] + apart * nb / n).otherwise(F.coalesce(b["mean"], a["mean"]))
    m2 = F.when(both, a["m2"] + b["m2"] + apart * apart * na * nb / n).otherwise(F.coalesce(b["m2"], a["m2"]))
    # equal values have no deviation, whatever their means round to (least and greatest skip nulls)
    equal = F.least(a["low"], b["low"]) == F.greatest(a["high"], b["high"])
    m2 = F.when(equal, F.lit(0.0)).otherwise(m2)
    ok = n >= F.lit(opts.periods)
    out = placed.withColumns({"n_obs": n, "rolling_mean": F.when(ok, mean),
                              "rolling_std": F.when(ok, F.sqrt(m2 / n))})
    out = out.drop("_pos", "_block", "_rest", "_head", "_tail")
    return out.withColumn("z", safe_ratio(v - F.col("rolling_mean"), F.col("rolling_std")))
