"""One monitoring run as a Spark job: detect -> summarise -> co-occurrence -> suppress ->
state snapshot -> alert digest -> report tables.

Nothing is collected: every product is a DataFrame, written when a base path is given.
``run_ts``/``run_id`` are injected (never the wall clock inside a query).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.annotate import summarize, summary_view
from ..operators.cooccur import attach_notes
from ..operators.digest import (alert_body_lines, alert_subject, digest_items, item_text,
                                write_alert_text)
from ..operators.report import report_tables, write_report
from ..operators.rolling import detect_long
from ..operators.suppress import apply_suppression, kept_only, observed_from_metrics
from ..options import CoOccurrenceOptions, DetectOptions, SuppressOptions
from ..sources.lookback import split_late
from ..sources.metrics import WideMetrics, to_long
from ..session import cut_lineage
from ..sources.state import read_state, write_state
from ..sources.state_log import commit_state, read_log, version_before


@dataclass
class MonitorConfig:
    detect: DetectOptions = field(default_factory=DetectOptions)
    suppress: SuppressOptions = field(default_factory=SuppressOptions)
    co_occurrence: CoOccurrenceOptions = field(default_factory=CoOccurrenceOptions)
    run_id: str = ""                    # needed with state_base; ids sort in the order of the runs
    run_ts: str = "1970-01-01 00:00:00"
    state_base: str | None = None
    state_log: str | None = None        # instead of state_base: only changed rows are written
    report_base: str | None = None
    tiebreak: tuple[str, ...] = ()


#: Marks this run's rows among those of earlier runs; the last thing that rows are ordered by.
NEW = "_new"


def run_monitor(spark: SparkSession, wide: WideMetrics, config: MonitorConfig,
                state: DataFrame | None = None, history: DataFrame | None = None) -> dict[str, DataFrame]:
    """``history``: rows of earlier runs (long form) that this run's windows look back at; they are not
    scored again. Rows of ``wide`` that are not later than their series' last row there come back as
    ``late`` and are left out."""
    if (config.state_base or config.state_log or config.report_base) and not config.run_id:
        raise ValueError("A run that writes needs a run_id: ids tell earlier runs from later ones.")
    if config.state_base and config.state_log:
        raise ValueError("State goes to state_base or to state_log, not to both.")
    keys = list(wide.keys)
    long = to_long(wide.df, wide.ts, wide.metrics, keys, carry=list(config.tiebreak))
    out = {}
    found, order_by = long, list(config.tiebreak)
    if history is not None:
        found, out["late"] = split_late(long, history, keys, "ts", order_by)
        found = long = cut_lineage(found, "new-rows")
        found = history.select(long.columns).withColumn(NEW, F.lit(False)).unionByName(long.withColumn(NEW, F.lit(True)))
        order_by.append(NEW)
    # one pass over all points; everything after reads the (small) anomaly table
    anomalies = detect_long(found, config.detect, keys, "ts", order_by)
    if history is not None:
        anomalies = anomalies.filter(NEW).drop(NEW)
    anomalies = cut_lineage(anomalies)
    annotated = attach_notes(summarize(anomalies), config.co_occurrence, keys)
    if config.state_log:
        version = version_before(spark, config.state_log, config.run_id)
        if state is None and version:
            state = read_log(spark, config.state_log, keys, version=version)
    elif state is None:
        state = read_state(spark, config.state_base, keys, before=config.run_id)
    order = ("event_ts", *config.tiebreak)
    in_range = None
    if config.suppress.reset_scope == "point":
        # every non-null point that was not flagged resets its series; the anti-join's
        # small side is the anomaly table
        points = long.filter(F.col("value").isNotNull()).select(
            *keys, "metric", F.col("ts").alias("event_ts"), *config.tiebreak)
        flagged = anomalies.select(*keys, "metric", F.col("timestamp").alias("event_ts"),
                                   *config.tiebreak)
        in_range = points.join(flagged, [*keys, "metric", *order], "left_anti")
    # observed series: every metric column of the run, even all-null ones (from the schema;
    # with entity keys, every key present in the run times every metric)
    if in_range is not None:
        observed = in_range.select(*keys, "metric").distinct()      # a point resets, not a column's presence
    elif keys:
        observed = wide.df.select(*keys).distinct().withColumn(
            "metric", F.explode(F.array(*[F.lit(m) for m in wide.metrics])))
    else:
        observed = observed_from_metrics(spark, wide.metrics)
    decisions, new_state = apply_suppression(
        annotated, state, observed, config.suppress, config.run_ts, keys,
        order=order, in_range=in_range)
    kept = kept_only(decisions)
    if config.state_base:
        write_state(new_state, config.state_base, config.run_id)
    if config.state_log:
        commit_state(new_state, config.state_log, config.run_id, version, keys)
    out |= {
        "points": long,
        "anomalies": anomalies,
        "summaries": summary_view(decisions, keys),
        "decisions": decisions,
        "state": new_state,
        "alert_subject": alert_subject(kept, config.run_ts),
        "alert_items": item_text(digest_items(kept, keys)),
        "alert_body": alert_body_lines(kept, config.run_ts, keys),
    }
    report = report_tables(long, kept, config.run_id, config.detect.mode, config.run_ts, keys)
    if config.report_base:
        write_report(report, config.report_base, config.run_id)
        write_alert_text(out["alert_body"], f"{config.report_base}/run={config.run_id}/alert_text")
    out.update({f"report_{k}": v for k, v in report.items()})
    return out
