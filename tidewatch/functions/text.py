"""Text columns for anomaly summaries and alert digests, as Catalyst expressions.

Number formatting uses ``format_number`` with DecimalFormat patterns: they round the exact
binary value half-even, which is what Python's ``%.2f`` does (``format_string`` rounds
half-up and differs on ties).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# These must equal the monitored job's wording and rules exactly.
# ---------------------------------------------------------------------------

# Impact hints: lower-cased metric name, first rule with a matching substring wins.
IMPACT_RULES: list[tuple[tuple[str, ...], str]] = [
    (("revenue", "sales", "income", "profit"), "financial performance"),
    (("cost", "expense", "spend"), "operating costs"),
    (("error", "fail", "crash", "5xx"), "system reliability"),
    (("latency", "response_time", "p99", "p95"), "user experience / performance"),
    (("user", "active", "signup", "session"), "user engagement"),
    (("cpu", "memory", "disk", "io"), "infrastructure health"),
    (("conversion", "click", "impression"), "marketing effectiveness"),
    (("order", "cart", "checkout"), "purchase funnel"),
]
IMPACT_FALLBACK = "operational metric (impact unclear without business context)"

# Severity bands on |z| (lower bound inclusive), checked from the top.
SEVERITY_BANDS: list[tuple[float, str]] = [
    (6.0, "extreme outlier"),
    (4.5, "well outside the typical range"),
    (3.0, "noticeably outside the typical range"),
]
SEVERITY_FALLBACK = "slightly outside the typical range"

# Co-occurrence note; {others} is the comma-joined list of other metrics.
CO_OCCURRENCE_NOTE = (
    "Note: this anomaly coincided with unusual movement in {others} on the "
    "same date. This may indicate a related cause, or may be coincidental "
    "- not confirmed causation."
)

# Summary sentences (pct_text is "{pct:+.1f}% vs baseline" or the near-zero text below;
# mode_tag is " [<mode>]" for modes other than zscore).
WHAT_CHANGED = ("{metric} {direction_word} from a baseline of {baseline} to {actual} "
                "({pct_text}) on {date}.")
SIGNIFICANCE = ("Z-score of {z_signed}{mode_tag} - this is {severity} "
                "(threshold: ±{threshold} std deviations).")
POSSIBLE_IMPACT = ("Given the column name '{metric}', this likely affects {impact}. "
                   "Confirm against your internal business glossary before acting on it.")
PCT_TEXT = "{pct} vs baseline"
DIRECTION_WORDS = {"up": "spiked", "down": "dropped"}

# Alert digest wording: subject lines, body header, item lines and footer.
SUBJECT_ESCALATIONS_ONLY = "[ANOMALY ESCALATION] {n_escalations} escalated anomaly/ies - {now}"
SUBJECT_MIXED = "[ANOMALY ALERT] {n_items} anomalies detected ({n_escalations} escalated) - {now}"
SUBJECT_NEW_ONLY = "[ANOMALY ALERT] {n_items} anomalies detected - {now}"
DIGEST_TITLE = "Anomaly Detection Agent - {n_items} alert item(s) at {now}"
DIGEST_COUNTS = "  New anomalies: {n_new}  |  Escalations: {n_escalations}"
DIGEST_RULE = "============================================================"
ITEM_HEADER_ESCALATION = "#{item_no}. [ESCALATION] {metric}  ({timestamp})  -  {direction_upper}"
ITEM_HEADER = "#{item_no}. {metric}  ({timestamp})  -  {direction_upper}"
ITEM_SEVERITY = "    Severity : {severity}  (z = {z_signed})"
ITEM_WHAT_CHANGED = "    What changed: {what_changed}"
ITEM_SIGNIFICANCE = "    Significance: {significance}"
ITEM_IMPACT = "    Possible impact: {possible_impact}"
ITEM_CORRELATION = "    Correlation: {correlation_note}"
DIGEST_FOOTER = "This is an automated alert. Investigate each item above."

# Threshold printed in the significance sentence (the job always prints 3.0).
SIGNIFICANCE_THRESHOLD_TEXT = "3.0"
NEAR_ZERO_BASELINE = 1e-9
NEAR_ZERO_TEXT = "baseline near zero (percent change not meaningful)"


# ---------------------------------------------------------------------------
# Formatting helpers
# ---------------------------------------------------------------------------

def fmt_fixed(c: Column, decimals: int = 2) -> Column:
    """Python ``f"{x:.Nf}"``."""
    pattern = "0." + "0" * decimals if decimals else "0"
    return F.call_function("format_number", c.cast("double"), F.lit(pattern))


def fmt_signed(c: Column, decimals: int = 2) -> Column:
    """Python ``f"{x:+.Nf}"``."""
    body = "0." + "0" * decimals if decimals else "0"
    return F.call_function("format_number", c.cast("double"), F.lit(f"+{body};-{body}"))


def date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def severity_label(z: Column) -> Column:
    a = F.abs(z)
    expr = None
    for bound, label in SEVERITY_BANDS:
        expr = F.when(a >= F.lit(bound), F.lit(label)) if expr is None else expr.when(
            a >= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(SEVERITY_FALLBACK))


def impact_label(metric: Column,
                 rules: Sequence[tuple[Sequence[str], str]] = IMPACT_RULES,
                 fallback: str = IMPACT_FALLBACK) -> Column:
    """First rule (in order) whose substring occurs in lower(metric)."""
    name = F.lower(metric)
    expr = None
    for needles, label in rules:
        cond = None
        for n in needles:
            hit = name.contains(n)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fallback)) if expr is not None else F.lit(fallback)


def fill(template: str, **values: Column) -> Column:
    """A ``{name}`` template as one ``concat`` of literal text and column values."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(values[name].cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def correlation_note(others_joined: Column) -> Column:
    head, tail = CO_OCCURRENCE_NOTE.split("{others}")
    return F.when(F.coalesce(others_joined, F.lit("")) != "",
                  F.concat(F.lit(head), others_joined, F.lit(tail))).otherwise(F.lit(""))
