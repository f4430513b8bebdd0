"""Trailing rolling z-score over row frames, for every series at once.

Each series is ``(keys..., metric)``; rows are ordered by ``ts`` plus optional tiebreak
columns. The frame is the last ``window_size`` rows, the current row included; mean and
*population* std cover its non-null values and are only defined when at least
``min_periods`` of them are non-null. ``count``, ``avg`` and ``stddev_pop`` over one window
spec collapse into one Window operator, so the series is sorted once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import safe_ratio
from ..options import DetectOptions

ANOMALY_COLUMNS = ["metric", "timestamp", "actual", "rolling_mean", "rolling_std", "z_score",
                   "direction", "detection_mode_used", "seasonal_period"]


def series_window(keys: Sequence[str], order: Sequence[str], extra_partition: Sequence[str] = ()):
    return Window.partitionBy(*keys, "metric", *extra_partition).orderBy(*order)


def rolling_columns(value: Column, window_size: int, min_periods: int, keys: Sequence[str],
                    order: Sequence[str], extra_partition: Sequence[str] = ()) -> dict[str, Column]:
    w = series_window(keys, order, extra_partition).rowsBetween(-(window_size - 1), 0)
    n = F.count(value).over(w)
    ok = n >= F.lit(min_periods)
    mean = F.when(ok, F.avg(value).over(w))
    sd = F.when(ok, F.stddev_pop(value).over(w))
    return {"n_obs": n, "rolling_mean": mean, "rolling_std": sd}


def rolling_stats(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                  ts: str = "ts", value: str = "value", tiebreak: Sequence[str] = (),
                  extra_partition: Sequence[str] = ()) -> DataFrame:
    """Add ``n_obs, rolling_mean, rolling_std, z`` to a long frame. Large windows take blocks."""
    from .blocks import LARGE_WINDOW, blocked_rolling_stats
    opts = options.validated()
    if opts.window_size > LARGE_WINDOW:
        return blocked_rolling_stats(long, opts, keys, ts, value, tiebreak, extra_partition)
    cols = rolling_columns(F.col(value), opts.window_size, opts.periods, keys, [ts, *tiebreak],
                           extra_partition)
    out = long.withColumns(cols)
    return out.withColumn("z", safe_ratio(F.col(value) - F.col("rolling_mean"),
                                          F.col("rolling_std")))


def flag_anomalies(scored: DataFrame, z_threshold: float, keys: Sequence[str] = (),
                   ts: str = "ts", actual: str = "value", mode: Column | str = "zscore",
                   period: Column | int | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Rows with ``|z| > threshold`` (strict) and a non-null observed value."""
    mode_col = mode if isinstance(mode, Column) else F.lit(mode)
    period_col = period if isinstance(period, Column) else F.lit(period)
    z = F.col("z")
    return (scored
            .filter(F.col(actual).isNotNull() & z.isNotNull() & (F.abs(z) > F.lit(z_threshold)))
            .select(*keys, "metric",
                    F.col(ts).alias("timestamp"),
                    F.col(actual).alias("actual"),
                    F.coalesce(F.col("rolling_mean"), F.lit(0.0)).alias("rolling_mean"),
                    F.coalesce(F.col("rolling_std"), F.lit(0.0)).alias("rolling_std"),
                    z.alias("z_score"),
                    F.when(z > 0, F.lit("up")).otherwise(F.lit("down")).alias("direction"),
                    mode_col.alias("detection_mode_used"),
                    period_col.cast("int").alias("seasonal_period"),
                    *extra))


def zscore_anomalies(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                     ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Plain rolling z-score detection on a long frame."""
    opts = options.validated()
    if opts.score_from is not None:
        return _score_from(long, opts, keys, ts, tiebreak)
    if opts.chunk_rows:
        from .halo import halo_rolling_stats
        scored = halo_rolling_stats(long, opts, keys, ts, "value", tiebreak).drop("pos")
    elif opts.hot_series_rows:
        scored = split_hot_rolling_stats(long, opts, keys, ts, tiebreak)
    else:
        scored = rolling_stats(long, opts, keys, ts, "value", tiebreak)
    return flag_anomalies(scored, opts.z_threshold, keys, ts, extra=tiebreak)


def lookback_input(long: DataFrame, start: Column, lookback: int, keys: Sequence[str] = (),
                   ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows at/after ``start`` plus the last ``lookback`` earlier rows of every series.

    ``row_number() <= k`` becomes a partial per-task limit before the shuffle, so a long or
    hot history costs at most k rows per task and series.
    """
    if lookback <= 0:
        return long.filter(F.col(ts) >= start)
    newest_first = Window.partitionBy(*keys, "metric").orderBy(
        F.col(ts).desc(), *[F.col(c).desc() for c in tiebreak])
    history = (long.filter(F.col(ts) < start)
               .withColumn("_rk", F.row_number().over(newest_first))
               .filter(F.col("_rk") <= F.lit(lookback)).drop("_rk"))
    return history.unionByName(long.filter(F.col(ts) >= start))


def _score_from(long: DataFrame, opts: DetectOptions, keys: Sequence[str], ts: str,
                tiebreak: Sequence[str]) -> DataFrame:
    from dataclasses import replace
    start = F.lit(opts.score_from).cast(long.schema[ts].dataType)
    recent = lookback_input(long, start, opts.window_size - 1, keys, ts, tiebreak)
    flagged = zscore_anomalies(recent, replace(opts, score_from=None), keys, ts, tiebreak)
    return flagged.filter(F.col("timestamp") >= start)


def split_hot_rolling_stats(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                            ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rolling statistics with hot series split into halo chunks.

    Series sizes come from one partially aggregated count (a hot series costs one row per
    task). The hot list is joined like any table: Spark broadcasts it where its measured size
    allows, and shuffles otherwise.
    """
    from .halo import halo_rolling_stats
    opts = options.validated()
    limit = int(opts.hot_series_rows)
    sk = [*keys, "metric"]
    hot = (long.groupBy(*sk).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > F.lit(limit)).select(*sk))
    cold = rolling_stats(long.join(hot, sk, "left_anti"), opts, keys, ts, "value", tiebreak)
    chunked = DetectOptions(**{**opts.__dict__, "chunk_rows": limit, "hot_series_rows": None})
    warm = halo_rolling_stats(long.join(hot, sk, "left_semi"), chunked, keys, ts, "value",
                              tiebreak).drop("pos")
    return cold.unionByName(warm)


def detect_anomalies(wide: DataFrame, ts: str, metrics: Sequence[str] | None = None,
                     keys: Sequence[str] = (), options: DetectOptions = DetectOptions(),
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """Wide table in, anomaly table out (schema ``ANOMALY_COLUMNS`` after the keys)."""
    from ..sources.metrics import metric_columns, to_long
    opts = options.validated()
    if metrics is None:
        metrics = metric_columns(wide.schema, ts, exclude=[*keys, *tiebreak])
    long = to_long(wide, ts, metrics, keys, carry=tiebreak)
    return detect_long(long, opts, keys, "ts", tiebreak)


def detect_long(long: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    opts = options.validated()
    if opts.mode == "zscore":
        return zscore_anomalies(long, opts, keys, ts, tiebreak)
    from .seasonal import seasonal_anomalies
    return seasonal_anomalies(long, opts, keys, ts, tiebreak)
