"""Co-occurring anomalies: other metrics of the same entity flagged on nearby dates.

No pairs are emitted: each (entity, date) gets one sorted set of metric names through a
partially-aggregated ``collect_set`` (its size is bounded by the number of metrics of one
entity), and every anomaly takes that set minus itself. For a +/-N-day window dates fall into
bins of N days, whose sets are built once; each date looks into its own bin and the two beside
it and keeps what is within N days, so a row has three copies at most, whatever N is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import correlation_note
from ..options import CoOccurrenceOptions


def _metric_dates(anomalies: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return anomalies.select(*keys, "metric", F.to_date(F.col(ts)).alias("date")).distinct()


def date_metric_sets(anomalies: DataFrame, keys: Sequence[str] = (), ts: str = "timestamp",
                     window_days: int = 0) -> DataFrame:
    """``(keys..., date, names)``: sorted distinct metrics flagged within +/-N days."""
    md = _metric_dates(anomalies, keys, ts)
    if window_days <= 0:
        return md.groupBy(*keys, "date").agg(F.array_sort(F.collect_set("metric")).alias("names"))
    n = int(window_days)
    binned = md.withColumn("_bin", F.floor(F.unix_date("date") / n))
    bins = binned.groupBy(*keys, "_bin").agg(F.collect_set(F.struct("date", "metric")).alias("_near"))
    looks = binned.select(*keys, "date", F.explode(F.array(*[F.col("_bin") + k for k in (-1, 0, 1)])).alias("_bin"))
    within = F.filter("_near", lambda x: F.abs(F.date_diff(x["date"], F.col("date"))) <= n)
    names = F.transform(within, lambda x: x["metric"])
    return looks.distinct().join(bins, [*keys, "_bin"]).groupBy(*keys, "date").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(names)))).alias("names"))


def co_occurrences(anomalies: DataFrame, options: CoOccurrenceOptions = CoOccurrenceOptions(),
                   keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Other metrics per anomaly.

    mode 'window': ``(keys..., metric, date, others)`` for every anomalous (metric, date).
    mode 'strict': ``(keys..., metric, others)``: one list per metric taken from the last
    same-date cluster (>= 2 metrics) it belongs to; window_days does not widen it.
    """
    if options.mode == "strict":
        sets = date_metric_sets(anomalies, keys, ts, 0).filter(F.size("names") >= 2)
        per_metric = sets.select(*keys, "date", "names", F.explode("names").alias("metric"))
        return per_metric.groupBy(*keys, "metric").agg(
            F.max_by(F.array_remove("names", F.col("metric")), F.col("date")).alias("others"))
    if options.mode != "window":
        raise ValueError(f"Unknown co-occurrence mode: {options.mode}")
    md = _metric_dates(anomalies, keys, ts)
    sets = date_metric_sets(anomalies, keys, ts, options.window_days)
    return (md.join(sets, [*keys, "date"], "inner")
            .select(*keys, "metric", "date",
                    F.array_remove("names", F.col("metric")).alias("others")))


def attach_notes(annotated: DataFrame, options: CoOccurrenceOptions = CoOccurrenceOptions(),
                 keys: Sequence[str] = (), ts: str = "event_ts") -> DataFrame:
    """Fill ``co_occurrences`` and ``correlation_note`` on summarised anomalies."""
    co = co_occurrences(annotated, options, keys, ts)
    if options.mode == "strict":
        joined = annotated.join(co, [*keys, "metric"], "left")
    else:
        joined = (annotated.withColumn("date", F.to_date(F.col(ts)))
                  .join(co, [*keys, "metric", "date"], "left").drop("date"))
    others = F.coalesce(F.col("others"), F.array().cast("array<string>"))
    return (joined.withColumn("co_occurrences", others)
            .withColumn("correlation_note",
                        correlation_note(F.array_join(F.col("co_occurrences"), ", ")))
            .drop("others"))


def cluster_count(anomalies: DataFrame, keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Number of same-date clusters with at least two distinct metrics (one row)."""
    sets = date_metric_sets(anomalies, keys, ts, 0)
    return sets.agg(F.count_if(F.size("names") >= 2).cast("long").alias("clusters"))
