"""Report tables behind the run report: summary rows, chart series, run metadata.

Rendering (HTML, PNG) is left to whoever reads these tables; the series table is written
partitioned by metric so each chart reads only its own files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import fmt_signed
from .annotate import SUMMARY_COLUMNS


def report_table(kept: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Summary table rows: metric, date, direction, severity, z text, escalation badge."""
    return kept.select(*keys, "metric", F.col("timestamp").alias("date"), "direction",
                       "severity", fmt_signed(F.col("z_score")).alias("z_text"),
                       F.col("is_escalation").alias("escalation"))


def chart_series(long: DataFrame, kept: DataFrame, keys: Sequence[str] = (),
                 ts: str = "ts", kept_ts: str = "event_ts") -> DataFrame:
    """Non-null points of every metric with a kept anomaly, flagged where one was kept."""
    sk = [*keys, "metric"]
    marks = kept.select(*sk, F.col(kept_ts).alias(ts)).distinct().withColumn("is_anomaly",
                                                                             F.lit(True))
    metrics = kept.select(*sk).distinct()
    return (long.filter(F.col("value").isNotNull())
            .join(metrics, sk, "left_semi")
            .join(marks, [*sk, ts], "left")
            .select(*sk, ts, "value",
                    F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly")))


def run_metadata(kept: DataFrame, run_id: str, detection_mode: str, generated_at) -> DataFrame:
    """One row; none when nothing was kept (no report for an empty run)."""
    return (kept.agg(F.count(F.lit(1)).alias("n_anomalies"))
            .filter(F.col("n_anomalies") > 0)
            .select(F.lit(run_id).alias("run_id"), F.lit(detection_mode).alias("detection_mode"),
                    F.col("n_anomalies").cast("long").alias("n_anomalies"),
                    F.lit(str(generated_at)).alias("generated_at")))


def report_tables(long: DataFrame, kept: DataFrame, run_id: str, detection_mode: str,
                  generated_at, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    return {
        "metadata": run_metadata(kept, run_id, detection_mode, generated_at),
        "summary_table": report_table(kept, keys),
        "summaries": kept.select(*keys, *SUMMARY_COLUMNS),
        "chart_series": chart_series(long, kept, keys),
    }


def write_report(tables: dict[str, DataFrame], base: str, run_id: str) -> dict[str, str]:
    out = {}
    for name, df in tables.items():
        path = f"{base}/run={run_id}/{name}"
        writer = df.write.mode("overwrite")
        if name == "chart_series":
            # one task writes a metric's rows, so there is a file for each metric
            writer = df.repartition("metric").write.mode("overwrite").partitionBy("metric")
        writer.parquet(path)
        out[name] = path
    return out


def read_report(spark: SparkSession, base: str, run_id: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{base}/run={run_id}/{name}")
    return df.withColumn("metric", F.col("metric").cast("string")) if "metric" in df.columns else df
