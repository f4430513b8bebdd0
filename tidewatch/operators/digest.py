"""Alert digest: subject, numbered item blocks and the ordered body lines of one alert.

The digest is a table, not one string: items are numbered with a distributed global row
number (escalations first, then time order) and the body is a line table ordered by
``(section, item_no, line_no)`` that a writer emits in order. Nothing is gathered into a
single task or onto the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import (DIGEST_COUNTS, DIGEST_FOOTER, DIGEST_RULE, DIGEST_TITLE,
                              ITEM_CORRELATION, ITEM_HEADER, ITEM_HEADER_ESCALATION, ITEM_IMPACT,
                              ITEM_SEVERITY, ITEM_SIGNIFICANCE, ITEM_WHAT_CHANGED,
                              SUBJECT_ESCALATIONS_ONLY, SUBJECT_MIXED, SUBJECT_NEW_ONLY,
                              fill, fmt_signed)
from .ranking import global_row_number

FOOTER = DIGEST_FOOTER
RULE = DIGEST_RULE


def _now_text(run_ts) -> F.Column:
    return F.lit(str(run_ts))


def digest_items(kept: DataFrame, keys: Sequence[str] = (), ts: str = "event_ts") -> DataFrame:
    """``(item_no, keys..., metric, timestamp, is_escalation, lines)`` for kept summaries."""
    order = [F.col("is_escalation").desc(), F.col(ts), *[F.col(k) for k in keys], F.col("metric")]
    numbered = global_row_number(kept, order, "item_no")
    cols = {c: F.col(c) for c in ("item_no", "metric", "timestamp", "severity", "what_changed",
                                  "significance", "possible_impact")}
    cols["direction_upper"] = F.upper(F.col("direction"))
    cols["z_signed"] = fmt_signed(F.col("z_score"))
    header = F.when(F.col("is_escalation"), fill(ITEM_HEADER_ESCALATION, **cols)) \
        .otherwise(fill(ITEM_HEADER, **cols))
    note = F.coalesce(F.col("correlation_note"), F.lit(""))
    lines = F.array(
        header,
        fill(ITEM_SEVERITY, **cols),
        fill(ITEM_WHAT_CHANGED, **cols),
        fill(ITEM_SIGNIFICANCE, **cols),
        fill(ITEM_IMPACT, **cols),
        F.when(note != "", fill(ITEM_CORRELATION, correlation_note=note)),
    )
    return numbered.select("item_no", *keys, "metric", "timestamp", "is_escalation",
                           F.filter(lines, lambda x: x.isNotNull()).alias("lines"))


def item_text(items: DataFrame) -> DataFrame:
    return items.withColumn("text", F.array_join("lines", "\n")).drop("lines")


def alert_subject(kept: DataFrame, run_ts) -> DataFrame:
    """One row (none when nothing is kept): counts, subject and the body header lines."""
    now = _now_text(run_ts)
    agg = kept.agg(F.count(F.lit(1)).alias("n_items"),
                   F.count_if(F.col("is_escalation")).alias("n_escalations"))
    n, esc = F.col("n_items"), F.col("n_escalations")
    new = n - esc
    vals = {"n_items": n, "n_escalations": esc, "n_new": new, "now": now}
    subject = (F.when((esc > 0) & (new == 0), fill(SUBJECT_ESCALATIONS_ONLY, **vals))
               .when((esc > 0) & (new > 0), fill(SUBJECT_MIXED, **vals))
               .otherwise(fill(SUBJECT_NEW_ONLY, **vals)))
    return (agg.filter(n > 0)
            .select(n.cast("long").alias("n_items"), new.cast("long").alias("n_new"),
                    esc.cast("long").alias("n_escalations"), subject.alias("subject"),
                    fill(DIGEST_TITLE, **vals).alias("title"),
                    fill(DIGEST_COUNTS, **vals).alias("counts")))


def alert_body_lines(kept: DataFrame, run_ts, keys: Sequence[str] = ()) -> DataFrame:
    """Body of the alert as ``(section, item_no, line_no, line)``; empty when nothing kept."""
    subject = alert_subject(kept, run_ts)
    head = subject.select(F.posexplode(F.array("title", "counts", F.lit(RULE), F.lit("")))
                          .alias("line_no", "line")) \
        .select(F.lit(0).alias("section"), F.lit(0).cast("long").alias("item_no"),
                "line_no", "line")
    items = digest_items(kept, keys).select(
        "item_no", F.posexplode(F.concat("lines", F.array(F.lit("")))).alias("line_no", "line"))
    body = items.select(F.lit(1).alias("section"), "item_no", "line_no", "line")
    foot = subject.select(F.lit(2).alias("section"), F.lit(0).cast("long").alias("item_no"),
                          F.lit(0).alias("line_no"), F.lit(FOOTER).alias("line"))
    return head.unionByName(body).unionByName(foot)


def write_alert_text(body: DataFrame, path: str) -> str:
    """Write the body lines as text, in order: the sort range-partitions the lines, so
    reading the part files in name order yields the alert body line by line."""
    (body.orderBy("section", "item_no", "line_no").select("line")
     .write.mode("overwrite").text(path))
    return path
