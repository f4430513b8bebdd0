import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.operators.rolling import rolling_stats
from tidewatch.options import DetectOptions
from tidewatch.streaming import waiting
from tidewatch.streaming.sinks import read_batches, run_available_now
from tidewatch.streaming.stateful import stream_zscore

SCHEMA = pa.schema([("id", pa.int64()), ("name", pa.string()), (waiting.AT, pa.int64())])


class Handle:
    """State of one series in memory."""

    def __init__(self):
        self.map, self.value, self.timers = {}, None, set()

    def getMapState(self, *_):
        return self

    getValueState = getMapState

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def updateValue(self, key, value):
        self.map[key] = value

    def getValue(self, key):
        return self.map[key]

    def removeKey(self, key):
        del self.map[key]

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def frames(rows, size):
    for k in range(0, len(rows), size):
        part = pa.Table.from_pylist(sorted(rows[k:k + size], key=lambda r: r[waiting.AT]), SCHEMA)
        yield pd.DataFrame({waiting.ROWS: [waiting._blob(part)]})


def ordered(rows):
    """By time, then name, nulls last; equal ones as they came."""
    return [r["id"] for r in sorted(rows, key=lambda r: (r[waiting.AT], r["name"] is None, r["name"] or ""))]


@pytest.mark.parametrize("times", [40, 20_000, 10**9])
def test_waiting_rows_lie_in_small_blocks_and_come_out_in_order(monkeypatch, times):
    for name, size in (("RUN_BYTES", 20_000), ("BLOCK_BYTES", 2_000), ("RUNS", 4)):
        monkeypatch.setattr(waiting, name, size)
    rng = np.random.default_rng(times)
    handle = Handle()
    mark, alive, number = -1, [], 0

    def check(tables, mark):
        tables = list(tables)
        due = [r for r in alive if r[waiting.AT] // 1000 <= mark]
        assert [i for t in tables for i in t.column("id").to_pylist()] == ordered(due)
        assert max((t.num_rows for t in tables), default=0) < 1_000
        alive[:] = [r for r in alive if r[waiting.AT] // 1000 > mark]
        assert len(handle.timers) <= 1 and (not alive or handle.timers)

    for batch in range(12):
        new = [{"id": number + k, "name": [None, "a", "b", "c"][rng.integers(4)],
                waiting.AT: 1000 * (mark + int(rng.integers(-2, times)))} for k in range(3_000 if batch % 3 else 20)]
        number += len(new)
        buffer = waiting.Waiting(handle, SCHEMA, ["name"])
        check(buffer.taken(frames(new, 50), mark), mark)              # as Spark does: rows first, then timers
        alive += [r for r in new if r[waiting.AT] // 1000 > mark]
        assert len(handle.value[0]) <= 4 + 1                          # runs that were merged and the last one
        assert max((len(v[0]) for v in handle.map.values()), default=0) < 6_000
        mark += int(times * 0.4) if batch < 11 else 2 * times
        if batch % 2 and any(t < mark for t in handle.timers):
            handle.timers.clear()
            check(waiting.Waiting(handle, SCHEMA, ["name"]).taken([], mark, fired=True), mark)
    assert not alive and not handle.map and not handle.timers


def test_series_without_a_name_or_key_and_rows_without_a_time(spark, tmp_dir):
    ddl = "k long, metric string, ts timestamp_ntz, id long, value double"
    day = dt.datetime(2024, 1, 1)
    rows = [(k, m, day + dt.timedelta(hours=i), i, float(i % 7) if i % 5 else None)
            for k in (1, None) for m in ("a", None) for i in range(40)] + [(1, "a", None, 99, 1.0)]
    spark.createDataFrame(rows, ddl).repartition(3).write.parquet(f"{tmp_dir}/in/0")
    spark.createDataFrame([(9, "z", day + dt.timedelta(days=90), 0, 0.0)], ddl).coalesce(1).write.parquet(f"{tmp_dir}/in/1")
    stream = spark.readStream.schema(ddl).option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/in")
    opts = DetectOptions(window_size=10, min_periods=4)
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    path = run_available_now(stream_zscore(stream, opts, keys=["k"], carry=["id"], delay="9 days"), f"{tmp_dir}/out", "append")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == store
    plain = rolling_stats(spark.createDataFrame(rows, ddl).filter("ts IS NOT NULL"), opts, ["k"], tiebreak=["id"])
    cols = ["k", "metric", "ts", "id", "value", "n_obs", *(F.round(c, 6).alias(c) for c in ("rolling_mean", "rolling_std", "z"))]
    got, want = read_batches(spark, path).select(cols), plain.select(cols)
    assert got.count() == 160 and got.exceptAll(want).isEmpty()
