"""Versioned state snapshots: one parquet directory per run, newest complete one wins.

A run writes ``<base>/run=<run_id>/`` and Spark's ``_SUCCESS`` marker appears only when the
write committed, so readers pin the last complete version and a failed run leaves the old
state intact. Single writer per base path is assumed. Re-running the same run id rewrites
the same directory (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.suppress import empty_state


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def state_versions(spark: SparkSession, base: str) -> list[str]:
    """Committed run ids under ``base``, oldest first."""
    fs, hpath, jvm = _fs(spark, base)
    if not fs.exists(hpath):
        return []
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("run="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(name[len("run="):])
    return sorted(out)


def read_state(spark: SparkSession, base: str | None, keys: Sequence[str] = (),
               key_types: str = "", run_id: str | None = None,
               before: str | None = None) -> DataFrame:
    """The newest committed snapshot (or ``run_id``, or the newest older than ``before``);
    an empty table when there is none. Run ids must sort in run order (zero-padded)."""
    if base:
        versions = state_versions(spark, base)
        if before is not None:
            versions = [v for v in versions if v < before]
        if run_id is None and versions:
            run_id = versions[-1]
        if run_id is not None:
            return spark.read.parquet(f"{base}/run={run_id}")
    return empty_state(spark, keys, key_types)


def write_state(state: DataFrame, base: str, run_id: str) -> str:
    """Write one snapshot version; returns its path."""
    path = f"{base}/run={run_id}"
    state.write.mode("overwrite").parquet(path)
    return path
