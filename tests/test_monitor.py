import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tidewatch.options import DetectOptions, SuppressOptions
from tidewatch.plans.monitor import MonitorConfig, run_monitor
from tidewatch.sources.metrics import clean_wide
from tidewatch.sources.state import read_state


def wide_frame(spark, spikes, n=80, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rev = float(100 + rng.normal(0, 1) + spikes.get(i, 0.0))
        rows.append((dt.datetime(2024, 1, 1) + dt.timedelta(days=i), i, rev,
                     float(rng.normal(5, 0.3))))
    return spark.createDataFrame(rows, "Date timestamp_ntz, rid long, Revenue double, "
                                       "Error_Rate double")


def test_run_monitor_end_to_end(spark, tmp_dir):
    wide = clean_wide(wide_frame(spark, {40: 30.0, 41: 45.0, 60: 35.0}), "Date",
                      ["Revenue", "Error_Rate"])
    cfg = MonitorConfig(detect=DetectOptions(window_size=20), run_id="000000000001",
                        run_ts="2024-06-30 00:00:00", state_base=f"{tmp_dir}/state",
                        report_base=f"{tmp_dir}/report", tiebreak=("rid",))
    out = run_monitor(spark, wide, cfg)
    dec = {r.timestamp: r.decision for r in out["decisions"].filter("metric = 'Revenue'").collect()}
    assert dec["2024-02-10"] == "new"
    state = {r.metric: r for r in read_state(spark, f"{tmp_dir}/state").collect()}
    assert state["Revenue"].state == "active_anomaly"
    assert out["alert_subject"].count() == 1
    assert spark.read.parquet(f"{tmp_dir}/report/run=000000000001/chart_series") \
        .filter(F.col("is_anomaly")).count() >= 1


def test_run_monitor_point_scope(spark, tmp_dir):
    wide = clean_wide(wide_frame(spark, {40: 30.0, 60: 35.0}), "Date", ["Revenue"])
    run = MonitorConfig(detect=DetectOptions(window_size=20), suppress=SuppressOptions(),
                        run_ts="2024-06-30 00:00:00", tiebreak=("rid",))
    by_run = {r.timestamp: r.decision for r in run_monitor(spark, wide, run)["decisions"].collect()}
    point = MonitorConfig(detect=DetectOptions(window_size=20),
                          suppress=SuppressOptions(reset_scope="point"),
                          run_ts="2024-06-30 00:00:00", tiebreak=("rid",))
    out = run_monitor(spark, wide, point)
    by_point = {r.timestamp: r.decision for r in out["decisions"].collect()}
    assert by_run["2024-02-10"] == by_point["2024-02-10"] == "new"
    # in-range days between the two spikes reset the series under point scope only
    assert by_run["2024-03-01"] == "suppressed" and by_point["2024-03-01"] == "new"
    assert out["state"].collect()[0].state == "normal"     # the run ends in range


def test_run_monitor_writes_alert_text(spark, tmp_dir):
    import glob
    wide = clean_wide(wide_frame(spark, {40: 30.0}), "Date", ["Revenue"])
    cfg = MonitorConfig(detect=DetectOptions(window_size=20), run_id="000000000007",
                        run_ts="2024-06-30 00:00:00", report_base=f"{tmp_dir}/report")
    run_monitor(spark, wide, cfg)
    lines = []
    for part in sorted(glob.glob(f"{tmp_dir}/report/run=000000000007/alert_text/part-*")):
        with open(part) as fh:
            lines.extend(fh.read().split("\n")[:-1])
    assert lines[0] == "Anomaly Detection Agent - 1 alert item(s) at 2024-06-30 00:00:00"
    assert lines[4].startswith("#1. Revenue  (2024-02-10)  -  UP")
    assert lines[-1] == "This is an automated alert. Investigate each item above."


def test_runs_through_the_state_log_equal_snapshots(spark, tmp_dir):
    from tidewatch.sources.state_log import log_version, read_log
    frame = wide_frame(spark, {40: 30.0, 41: 45.0, 60: 35.0}).cache()
    for run, days in enumerate((55, 80, 15), 1):                # the last run sees no anomaly: a reset
        wide = clean_wide(frame.filter(F.col("rid") < days), "Date", ["Revenue", "Error_Rate"])
        for where in ({"state_base": f"{tmp_dir}/state"}, {"state_log": f"{tmp_dir}/log"}):
            run_monitor(spark, wide, MonitorConfig(detect=DetectOptions(window_size=20), run_id=f"{run:012d}",
                                                   run_ts=f"2024-06-{run:02d} 00:00:00", tiebreak=("rid",), **where))
        got = read_log(spark, f"{tmp_dir}/log").collect()
        assert log_version(spark, f"{tmp_dir}/log") == run and got
        assert sorted(got) == sorted(read_state(spark, f"{tmp_dir}/state").select(*got[0].__fields__).collect())
    assert {r.state for r in got} == {"normal"}
