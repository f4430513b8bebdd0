import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.options import DetectOptions, SuppressOptions
from tidewatch.plans.monitor import MonitorConfig, run_monitor
from tidewatch.sources.lookback import next_lookback, read_lookback, split_late
from tidewatch.sources.metrics import clean_wide
from tidewatch.sources.state import read_state, state_versions
from tidewatch.streaming.scheduled import read_records, run_batch

METRICS = ["revenue", "errors"]


def some_days(days, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(days):
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
        spike = 60.0 if i in (41, 42, 55, 75, 76, 88) else 0.0
        revenue = None if i in (30, 61) else float(100 + rng.normal() + spike * (1 + i / 50))
        rows.append((day, revenue, float(rng.normal(5, 0.5) + (9 if i in (50, 90) else 0))))
    return rows


def wide(spark, rows):
    return spark.createDataFrame(rows, "Date timestamp_ntz, revenue double, errors double")


def config(base):
    return MonitorConfig(detect=DetectOptions(window_size=20, min_periods=12, z_threshold=2.0),
                         suppress=SuppressOptions(reset_scope="point", escalation_z_delta=0.1),
                         run_ts="2024-06-30 00:00:00", run_id="whole", state_base=base)


def facts(anomalies, decisions, state):
    return (sorted((r.metric, r.timestamp, round(r.z_score, 9)) for r in anomalies.collect()),
            sorted((r.metric, r.timestamp, r.decision) for r in decisions.collect()),
            sorted((r.metric, r.state, r.last_alert_z and round(r.last_alert_z, 9), r.last_alert_at, r.last_value)
                   for r in state.collect()))


@pytest.mark.parametrize("cuts", [(43, 44), (20, 76)])
def test_any_cut_into_runs_equals_one_run(spark, tmp_dir, cuts):
    rows = some_days(100)
    one = run_monitor(spark, clean_wide(wide(spark, rows), "Date", METRICS), config(f"{tmp_dir}/one"))
    cuts = [0, *cuts, len(rows)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        run_batch(wide(spark, rows[a:b]), k, "Date", METRICS, config(f"{tmp_dir}/many"))
    many = [read_records(spark, f"{tmp_dir}/many", n) for n in ("anomalies", "decisions")]
    got = facts(*many, read_state(spark, f"{tmp_dir}/many"))
    assert got == facts(one["anomalies"], one["decisions"], one["state"])
    assert len({d for *_, d in got[1]}) > 1 and len(got[0]) > 8
    assert read_records(spark, f"{tmp_dir}/many", "late").count() == 0


def test_a_spike_in_a_short_run_is_found_and_a_replay_changes_nothing(spark, tmp_dir):
    rows = some_days(80)
    run_batch(wide(spark, rows[:70]), 0, "Date", METRICS, config(tmp_dir))
    first = run_batch(wide(spark, rows[70:]), 1, "Date", METRICS, config(tmp_dir))
    assert "2024-03-16" in {str(r.timestamp)[:10] for r in first["anomalies"].collect()}
    before = facts(*[read_records(spark, tmp_dir, n) for n in ("anomalies", "decisions")], read_state(spark, tmp_dir))
    kept = sorted(read_lookback(spark, tmp_dir, before="9").collect())
    run_batch(wide(spark, rows[70:]), 1, "Date", METRICS, config(tmp_dir))
    after = facts(*[read_records(spark, tmp_dir, n) for n in ("anomalies", "decisions")], read_state(spark, tmp_dir))
    assert before == after and state_versions(spark, tmp_dir) == ["000000000000", "000000000001"]
    assert sorted(read_lookback(spark, tmp_dir, before="9").collect()) == kept
    assert len(kept) == 19 * len(METRICS)


def test_late_rows_are_reported_and_left_out(spark, tmp_dir):
    rows = some_days(80)
    run_batch(wide(spark, rows[:60]), 0, "Date", METRICS, config(tmp_dir))
    late = [(rows[10][0], 1e9, 1e9), (rows[59][0], 1e9, 1e9)]
    run_batch(wide(spark, late + rows[60:]), 1, "Date", METRICS, config(tmp_dir))
    found = read_records(spark, tmp_dir, "late")
    assert found.count() == 2 * len(METRICS) and found.filter(F.col("value") != 1e9).count() == 0
    assert read_records(spark, tmp_dir, "anomalies").filter(F.col("actual") == 1e9).count() == 0


def test_null_keys_and_ties_in_the_lookback(spark):
    ddl = "region string, metric string, ts timestamp_ntz, id long, value double"
    day = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(None, "m", day, 1, 1.0), ("a", "m", day, 5, 1.0)], ddl)
    new = spark.createDataFrame([(None, "m", day, 1, 2.0), (None, "m", day, 2, 3.0), ("a", "m", day, 4, 4.0),
                                 ("b", "m", day, 0, 5.0)], ddl)
    good, late = split_late(new, old, ["region"], "ts", ["id"])
    assert sorted(r.value for r in good.collect()) == [3.0, 5.0]
    assert sorted(r.value for r in late.collect()) == [2.0, 4.0]
    kept = next_lookback(good, old, DetectOptions(window_size=2), ["region"], "ts", ["id"])
    assert sorted(((r.region or "", r.id) for r in kept.collect())) == [("", 2), ("a", 5), ("b", 0)]
    assert next_lookback(good, old, DetectOptions(mode="classical"), ["region"], "ts", ["id"]).count() == 4
