"""State as a base snapshot and the rows that each run changed.

``write_state`` writes all n series each run. Here a run writes only the rows that differ from
the version it read: ``<base>/parts/<uuid>`` holds a whole snapshot or one run's changes, and
``<base>/_log/<version>.json`` names the parts that make up a version (a snapshot and the changes
since, in order), so a reader opens one log entry, whatever the number of runs. Readers merge the
parts by series, the newest row first; every ``compact_after`` runs the merged table is written
as a new snapshot, which bounds the number of parts.

A version is published by renaming a finished file to its name, which fails if the name is taken:
of two writers that started from one version, one gets ``StateConflict`` and has published
nothing (its part is never named). This needs a file system whose rename without overwrite is
atomic, as HDFS's is. Series are never removed: one that is missing from a run's state keeps its row. Parts stay
until their owner removes them, so older versions can be read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.suppress import empty_state
from .state import _fs

COMPACT_AFTER = 16


class StateConflict(RuntimeError):
    """Another writer has published the version that this one wanted to write."""


def log_version(spark: SparkSession, base: str) -> int:
    """The newest version under ``base``, 0 if there is none."""
    fs, path, _ = _fs(spark, f"{base}/_log")
    if not fs.exists(path):
        return 0
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def log_entry(spark: SparkSession, base: str, version: int) -> dict:
    """What a version is made of: run_id, parts (paths below ``base``) and schema."""
    fs, path, jvm = _fs(spark, _entry_path(base, version))
    stream = fs.open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_log(spark: SparkSession, base: str, keys: Sequence[str] = (), key_types: str = "",
             version: int | None = None) -> DataFrame:
    """The state of a version (the newest unless given); version 0 is empty."""
    version = log_version(spark, base) if version is None else version
    if version == 0:
        return empty_state(spark, keys, key_types)
    entry = log_entry(spark, base, version)
    schema = StructType.fromJson(json.loads(entry["schema"]))
    parts = [spark.read.schema(schema).parquet(f"{base}/{part}") for part in entry["parts"]]
    return _merged(parts, [*keys, "metric"])


def commit_state(state: DataFrame, base: str, run_id: str, expected: int, keys: Sequence[str] = (),
                 compact_after: int = COMPACT_AFTER) -> int:
    """Publish ``state`` as version ``expected`` + 1, writing the rows that version ``expected`` has not.

    ``expected``: the version that the run read. A run id that has published this version already
    changes nothing. Returns the new version.
    """
    spark = state.sparkSession
    if _is_replay(spark, base, run_id, expected):
        return expected + 1
    parts, rows = [], state
    if expected:
        parts = log_entry(spark, base, expected)["parts"]
        old = read_log(spark, base, keys, version=expected).select(*state.columns)
        rows = state.subtract(old)             # nulls are equal here
        if len(parts) > compact_after:
            parts, rows = [], _merged([old, state], [*keys, "metric"]).select(*state.columns)
    part = f"parts/{uuid.uuid4().hex}"
    rows.write.parquet(f"{base}/{part}")
    entry = {"run_id": run_id, "parts": [*parts, part], "schema": state.schema.json()}
    if not _publish(spark, base, expected + 1, json.dumps(entry)) and not _is_replay(spark, base, run_id, expected):
        raise StateConflict(f"state version {expected + 1} of {base} was written by another run")
    return expected + 1


def version_before(spark: SparkSession, base: str, run_id: str) -> int:
    """The version that a run has to read: the newest, or the one before if the run published that."""
    newest = log_version(spark, base)
    return newest - 1 if newest and log_entry(spark, base, newest)["run_id"] == run_id else newest


def _merged(parts: list[DataFrame], sk: list[str]) -> DataFrame:
    """One row for each series, from the last part that has it."""
    if len(parts) == 1:
        return parts[0]
    columns = parts[0].columns
    rest = F.struct(*[c for c in columns if c not in sk])
    ordered = [part.select(*sk, rest.alias("_row"), F.lit(k).alias("_part")) for k, part in enumerate(parts)]
    every = ordered[0]
    for part in ordered[1:]:
        every = every.unionByName(part)
    return every.groupBy(*sk).agg(F.max_by("_row", "_part").alias("_row")).select(*sk, "_row.*").select(*columns)


def _entry_path(base: str, version: int) -> str:
    return f"{base}/_log/{version:020d}.json"


def _is_replay(spark: SparkSession, base: str, run_id: str, expected: int) -> bool:
    newest = log_version(spark, base)
    if newest > expected and log_entry(spark, base, expected + 1)["run_id"] == run_id:
        return True
    if newest != expected:
        raise StateConflict(f"state of {base} is at version {newest}, not {expected}")
    return False


def _publish(spark: SparkSession, base: str, version: int, text: str) -> bool:
    """Write a log entry whole or not at all; False if the version is taken."""
    fs, draft, jvm = _fs(spark, f"{base}/_log/draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    options = jvm.org.apache.hadoop.fs.Options.Rename
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(_entry_path(base, version)))
    try:
        context.rename(fs.makeQualified(draft), target, spark.sparkContext._gateway.new_array(options, 0))
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        fs.delete(draft, False)
        return False
    return True
