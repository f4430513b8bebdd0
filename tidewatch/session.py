"""Session construction and the shared checkpoint folder.

Everything in the library takes a ``SparkSession`` from the caller; this module only
offers a builder with settings that suit the workload (AQE on, UTC session clock, UI off)
and the one place that decides where lineage is cut.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # bounded history of executions/jobs/stages kept on the driver
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
                 max_shuffle_partitions: int = 200_000) -> dict[str, str]:
    """Settings sized to the input volume for a cluster run.

    Shuffle partitions start at input / target (AQE coalesces small ones and splits skewed
    ones at the same target), scan splits use the same target, and broadcasts stay at
    Spark's size-checked default threshold.
    """
    parts = max(200, min(max_shuffle_partitions, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(master: str | None = None, app: str = "tidewatch",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, reading it from the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; we never invent a
    machine-local one there. Only a local-mode session without the setting (tests) gets a
    fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):   # local-cluster has workers
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder before running")
        configured = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for tables written to cut lineage."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tidewatch", *parts)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    One write job (an RDD checkpoint of an unpersisted plan computes it twice), columnar on
    disk, and it survives executor loss: the files live in the shared folder, not on the
    executors. The read-back plan has no lineage above the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # known schema: no inference pass
