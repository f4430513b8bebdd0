"""Scheduled runs as a stream: each micro-batch of new rows is one monitoring run.

``trigger(availableNow=True)`` processes what has arrived and stops, like a scheduled job.
The run id is the zero-padded batch id. A run reads the newest state and the newest lookback
rows *before* it, so a replayed batch recomputes from the same input and rewrites the same
versions. With its lookback a run scores its rows as if all earlier rows were there: over any cut
of a table into micro-batches in time order, the runs' anomalies are together those of one run
over the whole table, and with ``reset_scope='point'`` so are the decisions and the state. (With
``reset_scope='run'`` a run that sees no anomaly of a series resets it, so there the cut matters.)

Under ``state_base``: ``run=…`` (state), ``lookback/run=…``, ``anomalies/run=…``,
``decisions/run=…`` and ``late/run=…`` (rows not later than their series' last kept row; never
scored).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..plans.monitor import MonitorConfig, run_monitor
from ..sources.lookback import next_lookback, read_lookback, write_lookback
from ..sources.metrics import clean_wide
from ..sources.state import state_versions

RECORDS = ("anomalies", "decisions", "late")


def run_batch(batch: DataFrame, batch_id: int, ts: str, metrics: Sequence[str],
              config: MonitorConfig, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """One scheduled run over the new rows ``batch``."""
    if not config.state_base:
        raise ValueError("scheduled runs need config.state_base for the state snapshots")
    spark, base = batch.sparkSession, config.state_base
    cfg = replace(config, run_id=f"{batch_id:012d}")
    wide = clean_wide(batch, ts, list(metrics), [*keys, *config.tiebreak])
    wide.keys = list(keys)
    history = read_lookback(spark, base, before=cfg.run_id)
    # writes the state version and, with report_base, the report tables and alert text
    out = run_monitor(spark, wide, cfg, history=history)
    for name in RECORDS:
        if name in out:
            out[name].write.mode("overwrite").parquet(f"{base}/{name}/run={cfg.run_id}")
    write_lookback(next_lookback(out["points"], history, config.detect, keys, "ts", list(config.tiebreak)),
                   base, cfg.run_id)
    return out


def run_scheduled(stream: DataFrame, ts: str, metrics: Sequence[str], config: MonitorConfig,
                  checkpoint: str, keys: Sequence[str] = ()) -> None:
    if not config.state_base:
        raise ValueError("scheduled runs need config.state_base for the state snapshots")

    def each(batch: DataFrame, batch_id: int) -> None:
        run_batch(batch, batch_id, ts, metrics, config, keys)

    query = (stream.writeStream.foreachBatch(each)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_records(spark: SparkSession, base: str, name: str) -> DataFrame:
    """All runs' ``anomalies``, ``decisions`` or ``late`` rows, with the run's id. Only committed
    writes are read."""
    versions = state_versions(spark, f"{base}/{name}")
    return (spark.read.option("basePath", f"{base}/{name}").schema(
        spark.read.parquet(f"{base}/{name}/run={versions[0]}").schema.add("run", "string"))
        .parquet(*[f"{base}/{name}/run={v}" for v in versions]))
