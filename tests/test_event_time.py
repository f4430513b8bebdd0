import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators.rolling import rolling_stats
from tidewatch.operators.suppress import apply_suppression
from tidewatch.options import DetectOptions, SuppressOptions
from tidewatch.streaming.sinks import read_batches, run_available_now
from tidewatch.streaming.stateful import decide_streak, stream_suppression, stream_zscore

DDL = "metric string, event_ts timestamp_ntz, timestamp string, z_score double, actual double, is_anomaly boolean"


def points(seed, days=60):
    rng = np.random.default_rng(seed)
    rows = []
    for m in ("a", "b"):
        for i in range(days):
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
            flag = bool(rng.random() < 0.6)
            z = float(rng.choice([-1, 1]) * (rng.uniform(3, 9) if flag else rng.uniform(0, 3)))
            rows.append((m, ts, ts.strftime("%Y-%m-%d"), z, float(i), flag))
    return rows


def files(spark, rows, schema, folder, parts, seed, closing):
    """Rows dealt out over files so that time goes back and forth, then one row far ahead."""
    rng = np.random.default_rng(seed)
    turn = [min(parts - 1, max(0, int((r[1] - rows[0][1]).days / 60 * parts + rng.integers(-1, 2)))) for r in rows]
    for k in range(parts):
        mine = [r for r, t in zip(rows, turn) if t == k]
        spark.createDataFrame([mine[j] for j in rng.permutation(len(mine))], schema).coalesce(1).write.parquet(f"{folder}/{k}")
    spark.createDataFrame([closing], schema).coalesce(1).write.parquet(f"{folder}/{parts}")
    return (spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", "1")
            .option("recursiveFileLookup", "true").parquet(folder))


END = ("(end)", dt.datetime(2025, 1, 1), "2025-01-01", 0.0, 0.0, False)


@pytest.mark.parametrize(("scope", "delta"), [("point", 2.0), ("point", 0.0), ("run", 0.5)])
def test_disordered_anomalies_are_decided_in_event_time(spark, tmp_dir, scope, delta):
    rows = points(4)
    if scope == "run":
        rows = [r for r in rows if r[5]]
    stream = files(spark, rows, DDL, f"{tmp_dir}/in", 5, 7, END)
    flag = "is_anomaly" if scope == "point" else None
    opts = SuppressOptions(escalation_z_delta=delta, reset_scope=scope)
    path = run_available_now(stream_suppression(stream, opts, anomaly_flag=flag, delay="40 days"), f"{tmp_dir}/out", "append")
    out = read_batches(spark, path)
    assert out.select("batch_id").distinct().count() > 1
    got = {(r.metric, r.event_ts): r.decision for r in out.collect()}
    whole = spark.createDataFrame(rows, DDL)
    events, quiet = whole.filter("is_anomaly"), whole.filter("NOT is_anomaly").select("metric", "event_ts")
    want, _ = apply_suppression(events.drop("is_anomaly"), None, None, opts, in_range=quiet if scope == "point" else None)
    assert got == {(r.metric, r.event_ts): r.decision for r in want.collect()} and len(got) == events.count()


def test_disordered_rows_are_scored_in_event_time_and_late_ones_dropped(spark, tmp_dir):
    ddl = "metric string, ts timestamp_ntz, id long, value double"
    rng = np.random.default_rng(2)
    rows = [("m", dt.datetime(2024, 1, 1) + dt.timedelta(days=int(i // 2)), i, None if i % 17 == 0 else float(rng.normal()))
            for i in range(120)]
    stream = files(spark, rows, ddl, f"{tmp_dir}/in", 4, 3, ("(end)", dt.datetime(2025, 1, 1), 0, 0.0))
    # behind the closing row this one is late, whatever its file
    spark.createDataFrame([("m", dt.datetime(2024, 1, 5), 999, 1e6)], ddl).coalesce(1).write.parquet(f"{tmp_dir}/in/9")
    opts = DetectOptions(window_size=15, min_periods=8)
    path = run_available_now(stream_zscore(stream, opts, carry=["id"], delay="40 days"), f"{tmp_dir}/out", "append")
    got = {r.id: (r.n_obs, r.z) for r in read_batches(spark, path).collect()}
    ref = rolling_stats(spark.createDataFrame(rows, ddl), opts, tiebreak=["id"]).collect()
    assert got.keys() == {r.id for r in ref}
    for r in ref:
        assert got[r.id][0] == r.n_obs and (r.z is None) == (got[r.id][1] is None)
        assert r.z is None or abs(r.z - got[r.id][1]) < 1e-9


def test_streaks_equal_a_loop():
    rng = np.random.default_rng(1)
    for delta in (0.0, 0.3, 2.0):
        for last in (None, 4.0):
            az = np.round(rng.uniform(3, 9, 50), 1)
            prev, want = last, []
            for z in az:
                if prev is None:
                    want.append("new")
                    prev = z
                elif z - prev >= delta:
                    want.append("escalation")
                    prev = z
                else:
                    want.append("suppressed")
            got, top = decide_streak(az, last, delta)
            assert got.tolist() == want and top == prev
