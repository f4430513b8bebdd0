"""Anomalies as records, and the sink that writes them in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

RECORD = ["metric", "timestamp", "actual", "rolling_mean", "rolling_std", "z_score", "direction",
          "detection_mode_used", "seasonal_period"]


def anomaly_records(anomalies: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``record``: each anomaly as JSON text, with an ISO timestamp and nulls kept."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    fields = [iso.alias(c) if c == "timestamp" else F.col(c) for c in (*keys, *RECORD)]
    return anomalies.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))


def write_ordered(anomalies: DataFrame, path: str, keys: Sequence[str] = ()) -> str:
    """Write anomalies by time, then metric: the sort deals them out by range, so that the part
    files in name order are the whole order."""
    anomalies.orderBy("timestamp", *keys, "metric").write.mode("overwrite").parquet(path)
    return path
