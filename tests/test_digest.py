import datetime as dt

from tidewatch.operators.annotate import summarize
from tidewatch.operators.cooccur import attach_notes
from tidewatch.operators.digest import alert_body_lines, alert_subject, digest_items, item_text
from tidewatch.operators.report import chart_series, report_table, run_metadata
from tidewatch.operators.suppress import apply_suppression, kept_only
from tidewatch.options import SuppressOptions

DDL = ("metric string, timestamp timestamp_ntz, actual double, rolling_mean double, "
       "rolling_std double, z_score double, direction string, detection_mode_used string, "
       "seasonal_period int")
RUN_TS = "2024-06-30 12:00:00"


#: The whole body of the alert over ``kept_rows``, line by line.
BODY = [
    "Anomaly Detection Agent - 4 alert item(s) at 2024-06-30 12:00:00",
    "  New anomalies: 3  |  Escalations: 1",
    "============================================================",
    "",
    "#1. [ESCALATION] Revenue  (2024-01-02)  -  UP",
    "    Severity : well outside the typical range  (z = +5.60)",
    "    What changed: Revenue spiked from a baseline of 520.00 to 990.00 (+90.4% vs baseline) on 2024-01-02.",
    "    Significance: Z-score of +5.60 - this is well outside the typical range (threshold: ±3.0 std deviations).",
    "    Possible impact: Given the column name 'Revenue', this likely affects financial performance. Confirm against your internal business glossary before acting on it.",
    "",
    "#2. Error_Rate  (2024-01-01)  -  DOWN",
    "    Severity : well outside the typical range  (z = -4.60)",
    "    What changed: Error_Rate dropped from a baseline of 1.50 to 0.00 (-100.0% vs baseline) on 2024-01-01.",
    "    Significance: Z-score of -4.60 - this is well outside the typical range (threshold: ±3.0 std deviations).",
    "    Possible impact: Given the column name 'Error_Rate', this likely affects system reliability. Confirm against your internal business glossary before acting on it.",
    "    Correlation: Note: this anomaly coincided with unusual movement in Revenue on the same date. This may indicate a related cause, or may be coincidental - not confirmed causation.",
    "",
    "#3. Revenue  (2024-01-01)  -  UP",
    "    Severity : noticeably outside the typical range  (z = +3.40)",
    "    What changed: Revenue spiked from a baseline of 500.00 to 900.00 (+80.0% vs baseline) on 2024-01-01.",
    "    Significance: Z-score of +3.40 - this is noticeably outside the typical range (threshold: ±3.0 std deviations).",
    "    Possible impact: Given the column name 'Revenue', this likely affects financial performance. Confirm against your internal business glossary before acting on it.",
    "    Correlation: Note: this anomaly coincided with unusual movement in Error_Rate on the same date. This may indicate a related cause, or may be coincidental - not confirmed causation.",
    "",
    "#4. Latency_ms  (2024-01-04)  -  UP",
    "    Severity : noticeably outside the typical range  (z = +3.90)",
    "    What changed: Latency_ms spiked from a baseline of 120.00 to 300.00 (+150.0% vs baseline) on 2024-01-04.",
    "    Significance: Z-score of +3.90 - this is noticeably outside the typical range (threshold: ±3.0 std deviations).",
    "    Possible impact: Given the column name 'Latency_ms', this likely affects user experience / performance. Confirm against your internal business glossary before acting on it.",
    "",
    "This is an automated alert. Investigate each item above.",
]


def kept_rows(spark):
    d = lambda day: dt.datetime(2024, 1, day)
    rows = [("Revenue", d(1), 900.0, 500.0, 50.0, 3.4, "up", "zscore", None),
            ("Error_Rate", d(1), 0.0, 1.5, 0.3, -4.6, "down", "zscore", None),
            ("Revenue", d(2), 990.0, 520.0, 50.0, 5.6, "up", "zscore", None),
            ("Latency_ms", d(4), 300.0, 120.0, 9.0, 3.9, "up", "zscore", None)]
    ann = attach_notes(summarize(spark.createDataFrame(rows, DDL)))
    dec, _ = apply_suppression(ann, None, None, SuppressOptions())
    return kept_only(dec)


def test_body_matches_rendering(spark):
    kept = kept_rows(spark)
    items = [r.asDict() for r in kept.orderBy("event_ts", "metric").collect()]
    assert [s["is_escalation"] for s in items] == [False, False, True, False]
    body = [r.line for r in alert_body_lines(kept, RUN_TS)
            .orderBy("section", "item_no", "line_no").collect()]
    assert body == BODY
    subj = alert_subject(kept, RUN_TS).collect()[0]
    assert subj.subject == f"[ANOMALY ALERT] 4 anomalies detected (1 escalated) - {RUN_TS}"
    texts = item_text(digest_items(kept)).orderBy("item_no").collect()
    assert texts[0].text.startswith("#1. [ESCALATION] Revenue  (2024-01-02)  -  UP")


def test_empty_run_has_no_alert_and_no_report(spark):
    kept = kept_rows(spark).limit(0)
    assert alert_subject(kept, RUN_TS).count() == 0
    assert alert_body_lines(kept, RUN_TS).count() == 0
    assert run_metadata(kept, "r1", "zscore", RUN_TS).count() == 0


def test_only_escalations_subject(spark):
    kept = kept_rows(spark).filter("is_escalation")
    assert alert_subject(kept, RUN_TS).collect()[0].subject == \
        f"[ANOMALY ESCALATION] 1 escalated anomaly/ies - {RUN_TS}"


def test_report_tables(spark):
    kept = kept_rows(spark)
    table = {(r.metric, r.date): (r.z_text, r.escalation) for r in report_table(kept).collect()}
    assert table[("Revenue", "2024-01-02")] == ("+5.60", True)
    series = spark.createDataFrame(
        [("Revenue", dt.datetime(2024, 1, d), float(d)) for d in range(1, 6)] +
        [("Other", dt.datetime(2024, 1, 1), 1.0), ("Revenue", dt.datetime(2024, 1, 6), None)],
        "metric string, ts timestamp_ntz, value double")
    pts = {(r.metric, r.ts.day): r.is_anomaly for r in chart_series(series, kept).collect()}
    assert pts == {("Revenue", 1): True, ("Revenue", 2): True, ("Revenue", 3): False,
                   ("Revenue", 4): False, ("Revenue", 5): False}
    meta = run_metadata(kept, "r1", "zscore", RUN_TS).collect()[0]
    assert meta.n_anomalies == 4


def test_alert_text_files_in_order(spark, tmp_dir):
    import glob
    from tidewatch.operators.digest import write_alert_text
    kept = kept_rows(spark)
    items = [r.asDict() for r in kept.orderBy("event_ts", "metric").collect()]
    path = write_alert_text(alert_body_lines(kept, RUN_TS).repartition(5), f"{tmp_dir}/body")
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part) as fh:
            lines.extend(fh.read().split("\n")[:-1])
    assert lines == BODY
