"""Metric cubes: time-bucket raw rows, group by dimensions, aggregate to metrics.

The aggregation is declared with ``groupBy(...).agg(...)`` so Spark does a partial
(map-side) aggregate before the shuffle: only one row per (task, bucket, dims) crosses the
network, whatever the skew of the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

_TRUNC_UNITS = {"year", "quarter", "month", "week", "hour", "minute", "second"}


def time_bucket(ts: Column, bucket: str) -> Column:
    """Bucket start for ``bucket`` in day | hour | week | month | ... | '<n> minutes'.

    Days are returned as DATE; other units as TIMESTAMP_NTZ.
    """
    b = bucket.strip().lower()
    if b == "day":
        return F.to_date(ts)
    if b in _TRUNC_UNITS:
        return F.date_trunc(b, ts).cast("timestamp_ntz")
    # arbitrary tumbling width such as '15 minutes'
    return F.window(ts, bucket).start.cast("timestamp_ntz")


def metric_cube(df: DataFrame, ts: str, aggs: Mapping[str, Column], bucket: str = "day",
                dims: Sequence[str] = (), ts_alias: str = "ts") -> DataFrame:
    """Wide cube ``(dims..., ts_alias, metric columns...)``, one row per bucket and dims."""
    exprs = [c.alias(name) for name, c in aggs.items()]
    return (df.groupBy(*dims, time_bucket(F.col(ts), bucket).alias(ts_alias))
            .agg(*exprs))


def pivot_cube(df: DataFrame, ts: str, category: str, values: Sequence[str], agg: Column,
               bucket: str = "day", dims: Sequence[str] = (), ts_alias: str = "ts",
               prefix: str = "") -> DataFrame:
    """One metric column per category value (values given, so no extra distinct job)."""
    grouped = df.groupBy(*dims, time_bucket(F.col(ts), bucket).alias(ts_alias))
    out = grouped.pivot(category, list(values)).agg(agg)
    if prefix:
        for v in values:
            out = out.withColumnRenamed(v, f"{prefix}{v}")
    return out
