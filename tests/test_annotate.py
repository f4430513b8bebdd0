import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions.text import impact_label, severity_label
from tidewatch.operators.annotate import summarize

ANOMALY_DDL = ("metric string, timestamp timestamp_ntz, actual double, rolling_mean double, "
               "rolling_std double, z_score double, direction string, "
               "detection_mode_used string, seasonal_period int")


def anomalies(spark, rows):
    return spark.createDataFrame(rows, ANOMALY_DDL)


def test_severity_edges(spark):
    df = spark.createDataFrame([(z,) for z in [2.99, 3.0, 4.49, 4.5, 5.99, 6.0, -6.5]], "z double")
    got = [r.s for r in df.select(severity_label(F.col("z")).alias("s")).collect()]
    assert got == ["slightly outside the typical range", "noticeably outside the typical range",
                   "noticeably outside the typical range", "well outside the typical range",
                   "well outside the typical range", "extreme outlier", "extreme outlier"]


def test_impact_rule_order(spark):
    names = ["conversion", "click", "transactions", "region", "Active_Users", "checkout",
             "Revenue", "p99_latency", "mystery"]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    got = [r.i for r in df.select(impact_label(F.col("m")).alias("i")).collect()]
    assert got == ["infrastructure health", "marketing effectiveness", "infrastructure health",
                   "infrastructure health", "user engagement", "purchase funnel",
                   "financial performance", "user experience / performance",
                   "operational metric (impact unclear without business context)"]


def test_summary_text(spark):
    ts = dt.datetime(2024, 3, 5, 0, 0)
    rows = [("Revenue", ts, 750.0, 500.0, 50.0, 5.0, "up", "zscore", None),
            ("Error_Rate", ts, -15.0, -10.0, 1.0, -3.2, "down", "seasonal", 7),
            ("Latency_ms", ts, 3.0, 0.0, 1.0, 3.1, "up", "zscore", None)]
    out = {r.metric: r for r in summarize(anomalies(spark, rows)).collect()}
    rev = out["Revenue"]
    assert rev.timestamp == "2024-03-05"
    assert rev.what_changed == ("Revenue spiked from a baseline of 500.00 to 750.00 "
                                "(+50.0% vs baseline) on 2024-03-05.")
    assert rev.significance == ("Z-score of +5.00 - this is well outside the typical range "
                                "(threshold: ±3.0 std deviations).")
    assert rev.possible_impact == ("Given the column name 'Revenue', this likely affects "
                                   "financial performance. Confirm against your internal "
                                   "business glossary before acting on it.")
    err = out["Error_Rate"]
    # negative baseline flips the sign of the percent change
    assert "(+50.0% vs baseline)" in err.what_changed
    assert err.significance.startswith("Z-score of -3.20 [seasonal] - this is noticeably")
    assert "baseline near zero (percent change not meaningful)" in out["Latency_ms"].what_changed
    assert rev.co_occurrences == [] and rev.correlation_note == "" and rev.is_escalation is False
