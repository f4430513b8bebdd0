"""Per-anomaly summary columns (severity, impact, sentences), all Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import safe_ratio
from ..functions.text import (DIRECTION_WORDS, IMPACT_FALLBACK, IMPACT_RULES,
                              NEAR_ZERO_BASELINE, NEAR_ZERO_TEXT, PCT_TEXT, POSSIBLE_IMPACT,
                              SIGNIFICANCE, SIGNIFICANCE_THRESHOLD_TEXT, WHAT_CHANGED, date_text,
                              fill, fmt_fixed, fmt_signed, impact_label, severity_label)

SUMMARY_COLUMNS = ["metric", "timestamp", "direction", "severity", "z_score", "actual",
                   "rolling_mean", "what_changed", "significance", "possible_impact",
                   "co_occurrences", "correlation_note", "is_escalation"]


def pct_change(actual: Column, mean: Column) -> Column:
    """(actual - mean) / mean * 100, NULL when the baseline is (near) zero."""
    usable = mean.isNotNull() & (mean != 0) & (F.abs(mean) >= F.lit(NEAR_ZERO_BASELINE))
    return F.when(usable, safe_ratio(actual - mean, mean) * F.lit(100.0))


def summarize(anomalies: DataFrame, impact_rules=IMPACT_RULES, impact_fallback=IMPACT_FALLBACK,
              threshold_text: str = SIGNIFICANCE_THRESHOLD_TEXT) -> DataFrame:
    """Anomaly rows -> anomaly rows plus summary columns.

    The typed timestamp moves to ``event_ts``; ``timestamp`` becomes the 'yyyy-MM-dd' text
    the summaries carry. ``co_occurrences``/``correlation_note``/``is_escalation`` start
    empty and are filled by the co-occurrence and suppression operators.
    """
    metric, ts = F.col("metric"), F.col("event_ts")
    z, actual, mean = F.col("z_score"), F.col("actual"), F.col("rolling_mean")
    word = F.when(F.col("direction") == "up", F.lit(DIRECTION_WORDS["up"])) \
        .otherwise(F.lit(DIRECTION_WORDS["down"]))
    pct = pct_change(actual, mean)
    pct_text = F.when(pct.isNotNull(),
                      fill(PCT_TEXT, pct=F.concat(fmt_signed(pct, 1), F.lit("%")))) \
        .otherwise(F.lit(NEAR_ZERO_TEXT))
    severity = severity_label(z)
    what = fill(WHAT_CHANGED, metric=metric, direction_word=word, baseline=fmt_fixed(mean),
                actual=fmt_fixed(actual), pct_text=pct_text, date=date_text(ts))
    mode = F.col("detection_mode_used")
    mode_tag = F.when(mode != "zscore", F.concat(F.lit(" ["), mode, F.lit("]"))).otherwise(F.lit(""))
    significance = fill(SIGNIFICANCE, z_signed=fmt_signed(z), mode_tag=mode_tag,
                        severity=severity, threshold=F.lit(threshold_text))
    impact = fill(POSSIBLE_IMPACT, metric=metric,
                  impact=impact_label(metric, impact_rules, impact_fallback))
    return (anomalies
            .withColumnRenamed("timestamp", "event_ts")
            .withColumns({
                "timestamp": date_text(ts),
                "severity": severity,
                "what_changed": what,
                "significance": significance,
                "possible_impact": impact,
                "co_occurrences": F.array().cast("array<string>"),
                "correlation_note": F.lit(""),
                "is_escalation": F.lit(False),
            }))


def summary_view(annotated: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The summary contract columns (keys first)."""
    return annotated.select(*keys, *SUMMARY_COLUMNS)
