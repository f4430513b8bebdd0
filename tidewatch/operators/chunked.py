"""Classical and STL seasonal scoring for hot series, chunk by chunk.

A series with a large share of all rows would sit in one task under per-series windows.
Here every row gets its position in the series (range-partitioned, no per-series task),
rows are cut into chunks of B positions, and each step works per chunk:

* gap fill: last value inside the chunk, else the last value of an earlier chunk (a window
  over the small per-chunk table), else the series' first value;
* centred trend: the chunk plus ``period // 2`` positions of each neighbour as a halo;
* seasonal: per-phase means (phase = position mod period) by partial aggregation;
* residual z: the chunk plus the ``window - 1`` preceding positions as a halo.

Results equal the per-series window path (tested); B must be at least the larger halo.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.numeric import safe_ratio
from ..options import DetectOptions
from ..session import cut_lineage
from .halo import series_positions
from .rolling import rolling_columns
from .stl import default_spans, reach, stl_pass


def _with_halo(df: DataFrame, chunk: int, before: int, after: int) -> DataFrame:
    """Rows of chunk c plus ``before`` positions of c-1 and ``after`` positions of c+1.

    ``_own`` marks the chunk's own rows."""
    off = F.col("pos") % F.lit(chunk)
    home = F.floor(F.col("pos") / F.lit(chunk)).cast("long")
    shifts = F.array(F.lit(0))
    if before > 0:   # my tail feeds the next chunk
        shifts = F.when(off >= F.lit(chunk - before), F.array_union(shifts, F.array(F.lit(1)))) \
            .otherwise(shifts)
    if after > 0:    # my head feeds the previous chunk
        shifts = F.when(off < F.lit(after), F.array_union(shifts, F.array(F.lit(-1)))) \
            .otherwise(shifts)
    return (df.withColumn("_shift", F.explode(shifts))
            .withColumn("_chunk", home + F.col("_shift"))
            .withColumn("_own", F.col("_shift") == 0).drop("_shift"))


def chunked_fill(pos: DataFrame, sk: Sequence[str], value: str = "value",
                 out: str = "filled") -> DataFrame:
    """Forward-then-back fill on rows carrying ``pos`` and chunk ``_c``.

    Within a chunk: last non-null so far; else the last non-null of an earlier chunk (a
    window over the per-chunk table, one row per chunk); else the series' first value.
    """
    sk = list(sk)
    known = pos.filter(F.col(value).isNotNull())
    chunk_last = known.groupBy(*sk, "_c").agg(F.max_by(value, "pos").alias("_cl"))
    chunks = pos.select(*sk, "_c").distinct().join(chunk_last, [*sk, "_c"], "left")
    earlier = Window.partitionBy(*sk).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.withColumn("_carry", F.last("_cl", ignorenulls=True).over(earlier)) \
        .select(*sk, "_c", "_carry")
    first = known.groupBy(*sk).agg(F.min_by(value, "pos").alias("_first"))
    inside = Window.partitionBy(*sk, "_c").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return (pos.join(carry, [*sk, "_c"], "left").join(first, sk, "left")
            .withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(inside),
                                        F.col("_carry"), F.col("_first")))
            .drop("_carry", "_first"))


def chunked_gap_fill(long: DataFrame, chunk: int, keys: Sequence[str] = (), ts: str = "ts",
                     tiebreak: Sequence[str] = (), value: str = "value",
                     out: str = "filled") -> DataFrame:
    """``gap_fill`` without a per-series task: positions, chunks, carried values."""
    sk = [*keys, "metric"]
    pos = series_positions(long, keys, ts, tiebreak).withColumn(
        "_c", F.floor(F.col("pos") / F.lit(chunk)).cast("long"))
    return chunked_fill(pos, sk, value, out).drop("pos", "_c")


def chunked_classical_scores(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                             ts: str = "ts", tiebreak: Sequence[str] = (),
                             chunk: int | None = None) -> DataFrame:
    """``long`` rows plus filled, trend, seasonal, resid, n_obs, rolling_mean, rolling_std, z."""
    opts = options.validated()
    p, w = opts.seasonal_period, opts.window_size
    half = p // 2
    chunk = int(chunk or opts.hot_series_rows or opts.chunk_rows)
    if chunk < max(half, w - 1):
        raise ValueError("chunk must be >= max(period // 2, window_size - 1)")
    sk = [*keys, "metric"]
    pos = series_positions(long, keys, ts, tiebreak).withColumn(
        "_c", F.floor(F.col("pos") / F.lit(chunk)).cast("long"))

    filled = chunked_fill(pos, sk)

    # centred trend with a two-sided halo ---------------------------------------------
    spread = _with_halo(filled, chunk, half, half)
    order = Window.partitionBy(*sk, "_chunk").orderBy("pos")
    frame = order.rowsBetween(-half, half)
    x = F.col("filled")
    if p % 2 == 1:
        trend = F.when(F.count(x).over(frame) == p, F.avg(x).over(frame))
    else:
        edges = F.lag(x, half).over(order) + F.lead(x, half).over(order)
        trend = F.when(F.count(x).over(frame) == p + 1,
                       (F.sum(x).over(frame) - F.lit(0.5) * edges) / F.lit(float(p)))
    trended = (spread.withColumn("trend", trend).filter(F.col("_own"))
               .drop("_chunk", "_own")
               .withColumn("_phase", F.col("pos") % F.lit(p)))

    # per-phase seasonal (partial aggregation) ------------------------------------------
    phase_means = trended.groupBy(*sk, "_phase").agg(
        F.avg(F.col("filled") - F.col("trend")).alias("_pm"))
    centre = phase_means.groupBy(*sk).agg(F.avg("_pm").alias("_centre"))
    seasonal = phase_means.join(centre, sk).select(
        *sk, "_phase", (F.col("_pm") - F.col("_centre")).alias("seasonal"))
    comp = (trended.join(seasonal, [*sk, "_phase"], "left")
            .withColumn("resid", x - F.col("trend") - F.col("seasonal"))
            .withColumn("expected", F.col("trend") + F.col("seasonal")).drop("_phase"))

    return _trailing_scores(comp, chunk, opts, keys)


def _trailing_scores(comp: DataFrame, chunk: int, opts: DetectOptions, keys: Sequence[str]) -> DataFrame:
    """Trailing residual z with a one-sided halo."""
    tail = _with_halo(comp, chunk, opts.window_size - 1, 0)
    cols = rolling_columns(F.col("resid"), opts.window_size, opts.periods, keys, ["pos"],
                           extra_partition=["_chunk"])
    scored = tail.withColumns(cols).filter(F.col("_own")).drop("_chunk", "_own", "_c")
    return scored.withColumn("z", safe_ratio(F.col("resid") - F.col("rolling_mean"),
                                             F.col("rolling_std")))


def chunked_stl(long: DataFrame, period: int, chunk: int, keys: Sequence[str] = (), ts: str = "ts",
                tiebreak: Sequence[str] = (), seasonal_span: int = 7, inner: int = 2,
                outer: int = 15) -> DataFrame:
    """``long`` rows plus pos, _c, filled, trend, seasonal, resid, expected: robust STL of long
    series, chunk by chunk, with the same results as one group for each series.

    One stage for each robustness iteration: chunks get the rows on both sides that their values
    can depend on (``stl.reach``), and run the inner loop from the trend and weights that the
    iteration before has written. The median residual, from which weights are made, comes from
    range-partitioned positions of the residuals, so no step gathers a series in one task.
    """
    trend_span, low_span = default_spans(period, seasonal_span)
    halo = reach(period, seasonal_span, trend_span, low_span, inner)
    chunk = max(int(chunk), halo)
    sk = [*keys, "metric"]
    pos = series_positions(long, keys, ts, tiebreak).withColumn(
        "_c", F.floor(F.col("pos") / F.lit(chunk)).cast("long"))
    base = cut_lineage(chunked_fill(pos, sk), "stl-base")
    sizes = base.groupBy(*sk).agg(F.count(F.lit(1)).alias("_n"))
    state = base.select(*sk, "pos", F.col("filled").alias("y"), F.lit(0.0).alias("t"), F.lit(0.0).alias("s"),
                        F.lit(1.0).alias("rw")).join(sizes, sk)
    fields = [state.schema[c] for c in (*sk, "pos", "_n", "y", "t", "s")]
    names = [f.name for f in fields]

    def step(pdf):
        if not pdf["_own"].any():              # beyond either end of the series
            return pdf.loc[pdf["_own"], names]
        pdf = pdf.sort_values("pos", ignore_index=True)
        y, t, rw = (pdf[c].to_numpy(dtype=float) for c in ("y", "t", "rw"))
        pdf["t"], pdf["s"] = stl_pass(y, t, rw, period, seasonal_span, trend_span, low_span, inner,
                                      int(pdf["pos"].iloc[0]), int(pdf["_n"].iloc[0]))
        return pdf.loc[pdf["_own"], names]

    for k in range(outer + 1):
        spread = _with_halo(state, chunk, halo, halo)
        fitted = cut_lineage(spread.groupBy(*sk, "_chunk").applyInPandas(step, StructType(fields)), "stl-pass")
        if k == outer:
            break
        left = F.abs(F.col("y") - F.col("t") - F.col("s"))
        ranked = series_positions(fitted.select(*sk, "_n", left.alias("_r")), keys, "_r", name="_k")
        middle = F.floor(F.col("_n") / 2)
        # six times the median: three times the sum of the two middle residuals
        six = ranked.groupBy(*sk).agg((3.0 * (
            F.sum(F.when(F.col("_k") == middle, F.col("_r")))
            + F.sum(F.when(F.col("_k") == F.col("_n") - 1 - middle, F.col("_r"))))).alias("_h"))
        h = F.col("_h")
        weight = (F.when(left <= 0.001 * h, 1.0)
                  .when(left <= 0.999 * h, F.pow(1.0 - F.pow(left / h, 2), 2)).otherwise(0.0))
        state = fitted.join(six, sk).withColumn("rw", weight).drop("_h")
    parts = base.join(fitted.select(*sk, "pos", F.col("t").alias("trend"), F.col("s").alias("seasonal")), [*sk, "pos"])
    return (parts.withColumn("resid", F.col("filled") - F.col("seasonal") - F.col("trend"))
            .withColumn("expected", F.col("trend") + F.col("seasonal")))


def chunked_stl_scores(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (), ts: str = "ts",
                       tiebreak: Sequence[str] = (), chunk: int | None = None) -> DataFrame:
    """``chunked_stl`` plus n_obs, rolling_mean, rolling_std, z of the residuals."""
    opts = options.validated()
    chunk = max(int(chunk or opts.hot_series_rows or opts.chunk_rows), opts.window_size - 1)
    return _trailing_scores(chunked_stl(long, opts.seasonal_period, chunk, keys, ts, tiebreak), chunk, opts, keys)
