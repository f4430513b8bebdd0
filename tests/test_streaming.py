import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tidewatch.operators.rolling import rolling_stats
from tidewatch.operators.suppress import apply_suppression
from tidewatch.options import DetectOptions, SuppressOptions
from tidewatch.plans.monitor import MonitorConfig
from tidewatch.sources.state import read_state, state_versions
from tidewatch.streaming.cube import stream_metric_cube
from tidewatch.streaming.scheduled import run_scheduled
from tidewatch.streaming.sinks import latest_by_key, read_batches, run_available_now
from tidewatch.streaming.stateful import stream_suppression, stream_zscore

EVENTS = "/root/testdata/sf0.001/events.parquet"


def split_by_time(spark, df, ts, folder, parts):
    """Write ``df`` as ``parts`` files in event-time order (one micro-batch each)."""
    bounds = np.linspace(0, 1, parts + 1)
    ranked = df.withColumn("_q", F.percent_rank().over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy(ts)))
    for i in range(parts):
        lo, hi = bounds[i], bounds[i + 1]
        cond = (F.col("_q") >= lo) & ((F.col("_q") < hi) if i < parts - 1 else F.lit(True))
        ranked.filter(cond).drop("_q").coalesce(1).write.parquet(f"{folder}/part{i:02d}")
    return df.schema


def stream_of(spark, folder, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
            .option("recursiveFileLookup", "true").parquet(folder))


def test_stream_zscore_equals_batch(spark, tmp_dir):
    ev = spark.read.parquet(EVENTS).select(F.col("event_type").alias("metric"), "event_id",
                                           "ts", "value")
    schema = split_by_time(spark, ev, "ts", f"{tmp_dir}/ev", 4)
    scored = stream_zscore(stream_of(spark, f"{tmp_dir}/ev", schema),
                           DetectOptions(window_size=20, min_periods=15), carry=["event_id"])
    path = run_available_now(scored, f"{tmp_dir}/out", "append")
    got = {r.event_id: r for r in read_batches(spark, path).collect()}
    assert read_batches(spark, path).select("batch_id").distinct().count() >= 3
    ref = rolling_stats(ev, DetectOptions(window_size=20, min_periods=15),
                        tiebreak=["event_id"]).collect()
    assert len(got) == len(ref)
    for r in ref:
        g = got[r.event_id]
        assert g.n_obs == r.n_obs
        for a, b in ((g.rolling_mean, r.rolling_mean), (g.rolling_std, r.rolling_std), (g.z, r.z)):
            assert (a is None and b is None) or abs(a - b) < 1e-7


EV_DDL = "metric string, event_ts timestamp_ntz, timestamp string, z_score double, actual double"


def anomaly_rows(spark):
    rng = np.random.default_rng(9)
    rows = []
    for m in ("a", "b", "c"):
        for i in range(40):
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
            z = float(rng.choice([-1, 1]) * rng.uniform(3.0, 9.0))
            rows.append((m, ts, ts.strftime("%Y-%m-%d"), z, float(i)))
    return spark.createDataFrame(rows, EV_DDL)


def test_stream_suppression_equals_batch(spark, tmp_dir):
    ev = anomaly_rows(spark)
    schema = split_by_time(spark, ev, "event_ts", f"{tmp_dir}/an", 5)
    decided = stream_suppression(stream_of(spark, f"{tmp_dir}/an", schema), SuppressOptions())
    path = run_available_now(decided, f"{tmp_dir}/dec", "append")
    got = {(r.metric, r.event_ts): r.decision for r in read_batches(spark, path).collect()}
    dec, _ = apply_suppression(ev, None, None, SuppressOptions())
    want = {(r.metric, r.event_ts): r.decision for r in dec.collect()}
    assert got == want and "escalation" in set(want.values())


def test_point_scope_resets_between_anomalies(spark, tmp_dir):
    rows = []
    for i, (flag, z) in enumerate([(True, 3.5), (True, 4.0), (False, 0.2), (True, 3.6),
                                   (True, 6.0), (False, 0.1), (True, 3.1)]):
        ts = dt.datetime(2024, 1, 1 + i)
        rows.append(("m", ts, ts.strftime("%Y-%m-%d"), z, 1.0, flag))
    df = spark.createDataFrame(rows, EV_DDL + ", is_anomaly boolean")
    df.coalesce(1).write.parquet(f"{tmp_dir}/pts/p0")
    stream = stream_of(spark, f"{tmp_dir}/pts", df.schema)
    decided = stream_suppression(stream, SuppressOptions(reset_scope="point"),
                                 anomaly_flag="is_anomaly")
    path = run_available_now(decided, f"{tmp_dir}/pdec", "append")
    got = [r.decision for r in read_batches(spark, path).orderBy("event_ts").collect()]
    assert got == ["new", "suppressed", "new", "escalation", "new"]


def test_stream_cube_equals_batch(spark, tmp_dir):
    ev = spark.read.parquet(EVENTS).select("ts", "event_type", "value")
    schema = split_by_time(spark, ev, "ts", f"{tmp_dir}/cube_in", 3)
    cube = stream_metric_cube(stream_of(spark, f"{tmp_dir}/cube_in", schema), "ts",
                              {"n": F.count(F.lit(1)), "v": F.sum("value")}, "1 day",
                              dims=["event_type"], watermark="2 days")
    path = run_available_now(cube, f"{tmp_dir}/cube_out", "update")
    got = {(r.event_type, r.ts): (r.n, round(r.v, 6))
           for r in latest_by_key(spark, path, ["event_type", "ts"]).collect()}
    ref = ev.groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")).collect()
    assert got == {(r.event_type, r.ts): (r.n, round(r.v, 6)) for r in ref}


def test_scheduled_runs_version_state(spark, tmp_dir):
    rng = np.random.default_rng(4)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(90):
        rev = float(100 + rng.normal(0, 1) + (40 if i in (55, 85) else 0))
        rows.append((start + dt.timedelta(days=i), rev, float(rng.normal(5, 0.5))))
    wide = spark.createDataFrame(rows, "Date timestamp_ntz, revenue double, errors double")
    schema = split_by_time(spark, wide, "Date", f"{tmp_dir}/wide", 3)
    cfg = MonitorConfig(detect=DetectOptions(window_size=20), run_ts="2024-06-30 00:00:00",
                        state_base=f"{tmp_dir}/state", report_base=f"{tmp_dir}/report")
    run_scheduled(stream_of(spark, f"{tmp_dir}/wide", schema), "Date", ["revenue", "errors"],
                  cfg, f"{tmp_dir}/ckpt")
    versions = state_versions(spark, f"{tmp_dir}/state")
    assert versions == ["000000000000", "000000000001", "000000000002"]
    final = {r.metric: r for r in read_state(spark, f"{tmp_dir}/state").collect()}
    # run 2 alerts on day 55; run 3 sees day 85 while still active and suppresses it
    assert final["revenue"].state == "active_anomaly"
    assert final["revenue"].last_alert_at == "2024-02-25"
    run2 = spark.read.text(f"{tmp_dir}/report/run=000000000001/alert_text")
    assert run2.filter(F.col("value").contains("revenue  (2024-02-25)")).count() == 1
    run3 = spark.read.text(f"{tmp_dir}/report/run=000000000002/alert_text")
    assert run3.count() == 0                      # suppressed: no alert
