"""Seasonal detection: decompose each series, then rolling z-score of the residuals.

Per series the history gate picks the path: enough non-null history (period x min_cycles)
-> STL (``mode='seasonal'``; grouped pandas function, one series per call) or classical
decomposition (``mode='classical'``; pure windows), either of them chunk by chunk for hot
series with the same results; otherwise a plain z-score fallback. Gap filling, the gate and the residual z-score stay in
Catalyst; only the loess smoother runs in Python. The window specs and the grouped
function all cluster on the series key, so the series is shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..options import DetectOptions
from .rolling import flag_anomalies, rolling_columns
from ..functions.numeric import safe_ratio
from .stl import stl_decompose


def gap_fill(long: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
             tiebreak: Sequence[str] = (), value: str = "value", out: str = "filled",
             chunk_rows: int | None = None) -> DataFrame:
    """Forward fill over all earlier rows, then back fill the leading gap.

    With ``chunk_rows`` the fill runs chunk by chunk on series positions (no per-series
    task; for very long or hot series)."""
    if chunk_rows:
        from .chunked import chunked_gap_fill
        return chunked_gap_fill(long, int(chunk_rows), keys, ts, tiebreak, value, out)
    base = Window.partitionBy(*keys, "metric").orderBy(ts, *tiebreak)
    past = base.rowsBetween(Window.unboundedPreceding, 0)
    # where nothing precedes, the next value is the series' first: one for the whole partition,
    # so the frame is not computed anew for each row
    whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return long.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(past),
                                           F.first(value, ignorenulls=True).over(whole)))


def history_gate(long: DataFrame, period: int, min_cycles: int, keys: Sequence[str] = (),
                 value: str = "value") -> DataFrame:
    """``(keys, metric, n_valid, n_rows, enough)`` per series (partial aggregation)."""
    need = period * min_cycles
    return (long.groupBy(*keys, "metric")
            .agg(F.count(value).alias("n_valid"), F.count(F.lit(1)).alias("n_rows"))
            .withColumn("enough", F.col("n_valid") >= F.lit(need)))


def _residual_scores(df: DataFrame, opts: DetectOptions, keys, ts, tiebreak) -> DataFrame:
    cols = rolling_columns(F.col("resid"), opts.window_size, opts.periods, keys, [ts, *tiebreak])
    out = df.withColumns(cols)
    return out.withColumn("z", safe_ratio(F.col("resid") - F.col("rolling_mean"),
                                          F.col("rolling_std")))


def classical_components(filled: DataFrame, period: int, keys: Sequence[str] = (),
                         ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Centred moving-average trend, per-phase mean seasonal (centred), residual.

    Phase = row position mod period. Trend is NULL where the centred window is incomplete,
    so the residual is NULL at both ends, as in the classical additive decomposition.
    """
    sk = [*keys, "metric"]
    order = Window.partitionBy(*sk).orderBy(ts, *tiebreak)
    x = F.col("filled")
    half = period // 2
    frame = order.rowsBetween(-half, half)
    if period % 2 == 1:
        trend = F.when(F.count(x).over(frame) == period, F.avg(x).over(frame))
    else:
        edges = F.lag(x, half).over(order) + F.lead(x, half).over(order)
        trend = F.when(F.count(x).over(frame) == period + 1,
                       (F.sum(x).over(frame) - F.lit(0.5) * edges) / F.lit(float(period)))
    comp = (filled.withColumn("_phase", (F.row_number().over(order) - 1) % F.lit(period))
            .withColumn("trend", trend)
            .withColumn("_detrended", x - F.col("trend")))
    phase_means = comp.groupBy(*sk, "_phase").agg(F.avg("_detrended").alias("_pm"))
    centred = phase_means.withColumn(
        "seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy(*sk)))
    return (comp.join(centred.select(*sk, "_phase", "seasonal"), [*sk, "_phase"], "left")
            .withColumn("resid", x - F.col("trend") - F.col("seasonal"))
            .withColumn("expected", F.col("trend") + F.col("seasonal"))
            .drop("_phase", "_detrended"))


def stl_components(filled: DataFrame, period: int, keys: Sequence[str] = (), ts: str = "ts",
                   tiebreak: Sequence[str] = (), seasonal_span: int = 7) -> DataFrame:
    """STL per series through ``applyInPandas``; adds trend, seasonal, resid and
    expected = trend + seasonal (the decomposition's baseline for the observed value)."""
    sk = [*keys, "metric"]
    order_cols = [ts, *tiebreak]
    fields = list(filled.schema.fields) + [StructField(c, DoubleType()) for c in
                                           ("trend", "seasonal", "resid", "expected")]
    schema = StructType(fields)
    names = [f.name for f in fields]

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order_cols, kind="mergesort").reset_index(drop=True)
        t, s, r = stl_decompose(pdf["filled"].to_numpy(dtype=float), period, seasonal_span)
        pdf["trend"], pdf["seasonal"], pdf["resid"], pdf["expected"] = t, s, r, t + s
        return pdf[names]

    return filled.groupBy(*sk).applyInPandas(decompose, schema)


def _route_expr(opts: DetectOptions, n_valid, n_rows):
    p = opts.seasonal_period
    # enough non-null history, and >= 2 full periods of (filled) rows for a decomposition
    usable = (n_valid >= F.lit(p * opts.min_cycles)) & (n_rows >= F.lit(2 * p))
    if opts.mode == "seasonal":
        return F.when(usable, F.lit("seasonal")).otherwise(F.lit("zscore"))
    return F.when(usable, F.lit("classical")).otherwise(F.lit("zscore"))


def series_routes(long: DataFrame, options: DetectOptions, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, metric, n_valid, n_rows, route)``: which path scores each series.

    seasonal or classical, as the mode says: gate passed; zscore: not enough history (fallback). Series with
    fewer than ``window_size`` rows still route but can yield nothing, as in the job.
    """
    opts = options.validated()
    gate = history_gate(long, opts.seasonal_period, opts.min_cycles, keys)
    return gate.select(*keys, "metric", "n_valid", "n_rows",
                       _route_expr(opts, F.col("n_valid"), F.col("n_rows")).alias("route"))


def seasonal_anomalies(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                       ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Seasonal (STL) or classical residual z-score, with the per-series fallbacks.

    The gate is a whole-partition window on the same series spec as every later window, so
    the input is shuffled and sorted once; the route filters sit above that Window node
    (they cannot be pushed below it) and the three branches reuse one exchange.
    """
    opts = options.validated()
    if opts.hot_series_rows or opts.chunk_rows:
        return _split_hot_seasonal(long, opts, keys, ts, tiebreak)
    p = opts.seasonal_period
    sk = [*keys, "metric"]
    whole = Window.partitionBy(*sk).orderBy(ts, *tiebreak).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    routed = long.withColumn("_route", _route_expr(opts, F.count("value").over(whole),
                                                   F.count(F.lit(1)).over(whole)))

    plain = routed.filter(F.col("_route") == "zscore")
    plain_scored = plain.withColumns(
        rolling_columns(F.col("value"), opts.window_size, opts.periods, keys, [ts, *tiebreak]))
    plain_scored = plain_scored.withColumn(
        "z", safe_ratio(F.col("value") - F.col("rolling_mean"), F.col("rolling_std")))
    out = flag_anomalies(plain_scored, opts.z_threshold, keys, ts, "value", "zscore", None,
                         extra=tiebreak)

    decomposed = gap_fill(routed.filter(F.col("_route") != "zscore"), keys, ts, tiebreak)
    if opts.mode == "seasonal":
        parts = [(stl_components(decomposed, p, keys, ts, tiebreak), "seasonal")]
    else:
        parts = [(classical_components(decomposed, p, keys, ts, tiebreak), "classical")]
    for comp, mode in parts:
        scored = _residual_scores(comp, opts, keys, ts, tiebreak)
        out = out.unionByName(flag_anomalies(scored, opts.z_threshold, keys, ts, "value", mode, p,
                                             extra=tiebreak))
    return out


def _split_hot_seasonal(long: DataFrame, opts: DetectOptions, keys: Sequence[str], ts: str,
                        tiebreak: Sequence[str]) -> DataFrame:
    """Series above ``hot_series_rows`` rows take the chunked classical path (or halo
    z-scores when their history is too short); the others take the per-series path.

    The hot list comes from one partially aggregated size pass and is joined like any table
    (Spark broadcasts it only where its size allows). The chunked decompositions give the same
    results as the plain ones.
    """
    from dataclasses import replace

    from .chunked import chunked_classical_scores, chunked_stl_scores
    from .halo import halo_rolling_stats
    limit = int(opts.hot_series_rows or opts.chunk_rows)
    sk = [*keys, "metric"]
    p = opts.seasonal_period
    sizes = (long.groupBy(*sk).agg(F.count("value").alias("_n_valid"),
                                   F.count(F.lit(1)).alias("_n_rows"))
             .filter(F.col("_n_rows") > F.lit(limit)))
    hot = sizes
    cold = seasonal_anomalies(long.join(hot.select(*sk), sk, "left_anti"),
                              replace(opts, hot_series_rows=None, chunk_rows=None), keys, ts, tiebreak)
    usable = (F.col("_n_valid") >= F.lit(p * opts.min_cycles)) & (F.col("_n_rows") >= F.lit(2 * p))
    hot_rows = long.join(hot.withColumn("_usable", usable).select(*sk, "_usable"), sk, "inner")
    scores = chunked_stl_scores if opts.mode == "seasonal" else chunked_classical_scores
    chunked = scores(hot_rows.filter("_usable").drop("_usable"), opts, keys,
                                       ts, tiebreak, chunk=limit)
    short = halo_rolling_stats(hot_rows.filter("NOT _usable").drop("_usable"),
                               replace(opts, chunk_rows=limit, hot_series_rows=None), keys, ts,
                               "value", tiebreak)
    return (cold
            .unionByName(flag_anomalies(chunked, opts.z_threshold, keys, ts, "value", opts.mode,
                                        p, extra=tiebreak))
            .unionByName(flag_anomalies(short, opts.z_threshold, keys, ts, "value", "zscore",
                                        None, extra=tiebreak)))
