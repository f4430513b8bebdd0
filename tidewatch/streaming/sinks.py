"""Idempotent micro-batch sinks for update-mode streams.

``foreachBatch`` writes each micro-batch to ``<path>/batch_id=<n>`` with overwrite, so a
replayed batch rewrites the same directory. The current result is the newest version of
every key (``max_by`` over batch id: partial aggregation, no single-task step).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path


#: Where a stream keeps its state: the stateful operators need RocksDB.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def new_stream_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def batch_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def run_available_now(stream: DataFrame, path: str, output_mode: str = "update",
                      timeout_s: int | None = None, settings: Mapping[str, str] = STATE_STORE) -> str:
    """Process everything available now through the idempotent sink; returns ``path``. ``settings``
    of the session hold for this query alone."""
    conf = stream.sparkSession.conf
    before = {key: conf.get(key) for key in settings}
    try:
        for key, value in settings.items():             # a query keeps those of its start
            conf.set(key, value)
        query = (stream.writeStream.outputMode(output_mode)
                 .foreachBatch(batch_writer(f"{path}/data"))
                 .option("checkpointLocation", f"{path}/_checkpoint")
                 .trigger(availableNow=True)
                 .start())
    finally:
        for key, value in before.items():
            conf.set(key, value)
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise query.exception()
    return path


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data")


def latest_by_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key across all written micro-batches."""
    df = read_batches(spark, path)
    values = [c for c in df.columns if c not in set(keys) | {"batch_id"}]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])
