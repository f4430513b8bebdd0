import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.suppress import apply_suppression, observed_from_metrics
from tidewatch.options import SuppressOptions
from tidewatch.sources.state import read_state, state_versions, write_state

EV_DDL = "metric string, event_ts timestamp_ntz, timestamp string, z_score double, actual double"
ST_DDL = ("metric string, state string, last_alert_z double, last_alert_at string, "
          "last_value double, updated_at timestamp")


def events(spark, metric, zs, start_day=1):
    rows = []
    for i, z in enumerate(zs):
        ts = dt.datetime(2024, 1, start_day + i)
        rows.append((metric, ts, ts.strftime("%Y-%m-%d"), z, 100.0 + i))
    return spark.createDataFrame(rows, EV_DDL)


def decided(dec):
    return [r.decision for r in dec.orderBy("event_ts").collect()]


def state_of(st, metric):
    return [r for r in st.collect() if r.metric == metric][0]


def test_escalation_fold(spark):
    ev = events(spark, "m", [3.1, -4.9, 5.2, 3.5, 7.3])
    dec, st = apply_suppression(ev, None, None, SuppressOptions(True, 2.0), "2024-02-01 00:00:00")
    assert decided(dec) == ["new", "suppressed", "escalation", "suppressed", "escalation"]
    s = state_of(st, "m")
    assert s.state == "active_anomaly" and s.last_alert_z == pytest.approx(7.3)
    assert s.last_alert_at == "2024-01-05" and s.last_value == 104.0


def test_second_run_suppresses_everything(spark):
    ev = events(spark, "m", [3.1, -4.9, 5.2, 3.5, 7.3])
    _, st = apply_suppression(ev, None, None, SuppressOptions(), "2024-02-01 00:00:00")
    dec2, st2 = apply_suppression(ev, st, None, SuppressOptions(), "2024-02-02 00:00:00")
    assert set(decided(dec2)) == {"suppressed"}
    assert state_of(st2, "m").last_alert_z == pytest.approx(7.3)


def test_reset_unobserved_and_clean(spark):
    prior = spark.createDataFrame([
        ("quiet", "active_anomaly", 4.0, "2024-01-01", 9.0, dt.datetime(2024, 1, 1)),
        ("gone", "active_anomaly", 4.0, "2024-01-01", 8.0, dt.datetime(2024, 1, 1)),
        ("clean", "normal", None, None, 7.0, dt.datetime(2024, 1, 1))], ST_DDL)
    observed = observed_from_metrics(spark, ["quiet", "clean", "m"])
    ev = events(spark, "m", [3.5])
    _, st = apply_suppression(ev, prior, observed, SuppressOptions(), "2024-02-01 00:00:00")
    q = state_of(st, "quiet")
    assert (q.state, q.last_alert_z, q.last_alert_at, q.last_value) == ("normal", None, None, 9.0)
    assert state_of(st, "gone").state == "active_anomaly"              # not observed: unchanged
    c = state_of(st, "clean")
    assert c.updated_at == dt.datetime(2024, 1, 1)                      # already clean: no-op
    assert state_of(st, "m").state == "active_anomaly"


def test_active_with_null_z_escalates(spark):
    prior = spark.createDataFrame(
        [("m", "active_anomaly", None, None, 1.0, dt.datetime(2024, 1, 1))], ST_DDL)
    dec, _ = apply_suppression(events(spark, "m", [3.1]), prior, None, SuppressOptions())
    assert decided(dec) == ["escalation"]
    dec, st = apply_suppression(events(spark, "m", [1.5]), prior, None, SuppressOptions())
    assert decided(dec) == ["suppressed"]
    assert state_of(st, "m").last_alert_z == 0.0


def test_suppression_off_keeps_all(spark):
    ev = events(spark, "m", [3.1, 3.2, 3.3])
    dec, st = apply_suppression(ev, None, None, SuppressOptions(enabled=False))
    assert decided(dec) == ["kept"] * 3
    assert dec.filter(F.col("is_escalation")).count() == 0
    s = state_of(st, "m")
    assert s.last_alert_z == pytest.approx(3.3) and s.last_alert_at == "2024-01-03"


def test_many_series_at_once(spark):
    ev = events(spark, "a", [3.1, 4.9, 5.2]).unionByName(events(spark, "b", [6.0, 3.0, 8.1]))
    dec, _ = apply_suppression(ev, None, None, SuppressOptions())
    got = {(r.metric, r.event_ts.day): r.decision for r in dec.collect()}
    assert got == {("a", 1): "new", ("a", 2): "suppressed", ("a", 3): "escalation",
                   ("b", 1): "new", ("b", 2): "suppressed", ("b", 3): "escalation"}


def test_state_versions_roundtrip(spark, tmp_dir):
    base = f"{tmp_dir}/state"
    assert read_state(spark, base).count() == 0
    _, st = apply_suppression(events(spark, "m", [3.1]), None, None, SuppressOptions())
    write_state(st, base, "000000000001")
    _, st2 = apply_suppression(events(spark, "m", [9.9], 5), read_state(spark, base), None,
                               SuppressOptions())
    write_state(st2, base, "000000000002")
    assert state_versions(spark, base) == ["000000000001", "000000000002"]
    assert read_state(spark, base).collect()[0].last_alert_z == pytest.approx(9.9)
    assert read_state(spark, base, before="000000000002").collect()[0].last_alert_z == \
        pytest.approx(3.1)


def test_point_scope_batch(spark):
    # anomalies and in-range points of one run; every in-range point resets the series
    pts = [(True, 3.5), (True, 4.0), (False, 0.2), (True, 3.6), (True, 6.0), (False, 0.1),
           (True, 3.1)]
    rows = []
    for i, (flag, z) in enumerate(pts):
        ts = dt.datetime(2024, 1, 1 + i)
        rows.append(("m", ts, ts.strftime("%Y-%m-%d"), z, float(i), flag))
    df = spark.createDataFrame(rows, EV_DDL + ", is_anomaly boolean")
    ev = df.filter("is_anomaly").drop("is_anomaly")
    in_range = df.filter("NOT is_anomaly").select("metric", "event_ts")
    opts = SuppressOptions(reset_scope="point")
    dec, st = apply_suppression(ev, None, None, opts, in_range=in_range)
    assert decided(dec) == ["new", "suppressed", "new", "escalation", "new"]
    assert state_of(st, "m").state == "active_anomaly"
    # a run ending on an in-range point ends normal, keeping the last value
    dec, st = apply_suppression(ev.filter("event_ts < '2024-01-06'"), None, None, opts,
                                in_range=in_range)
    s = state_of(st, "m")
    assert (s.state, s.last_alert_z, s.last_alert_at, s.last_value) == ("normal", None, None, 4.0)
    # stored active state carries into the first segment only
    prior = spark.createDataFrame(
        [("m", "active_anomaly", 3.0, "2023-12-31", 1.0, dt.datetime(2024, 1, 1))], ST_DDL)
    dec, _ = apply_suppression(ev, prior, None, opts, in_range=in_range)
    assert decided(dec) == ["suppressed", "suppressed", "new", "escalation", "new"]
    with pytest.raises(ValueError):
        apply_suppression(ev, None, None, opts)


def fold(zs, delta, last=None):
    """The rules, one anomaly after the other."""
    out = []
    for z in map(abs, zs):
        if last is None:
            out.append("new")
            last = z
        elif z - last >= delta:
            out.append("escalation")
            last = z
        else:
            out.append("suppressed")
    return out


@pytest.mark.parametrize("delta", [0.0, 0.01])
def test_long_rising_series(spark, delta):
    n = 10_000
    ev = spark.range(n).select(
        F.lit("m").alias("metric"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("event_ts"),
        F.lit("d").alias("timestamp"), (3 + F.col("id") * 0.003).alias("z_score"), F.lit(1.0).alias("actual"))
    dec, _ = apply_suppression(ev, None, None, SuppressOptions(True, delta))
    assert decided(dec) == fold([3 + i * 0.003 for i in range(n)], delta)


def test_fold_in_several_steps_equals_the_rules(spark, monkeypatch):
    import random

    from tidewatch.operators import suppress
    monkeypatch.setattr(suppress, "FOLD_ROWS", 3)
    rng = random.Random(3)
    prior = spark.createDataFrame([("b", "active_anomaly", -4.0, "2024-01-01", 9.0, dt.datetime(2024, 1, 1))], ST_DDL)
    zs = {m: [rng.choice((-1, 1)) * (3 + rng.random() * 0.1 * i) for i in range(40)] for m in "abc"}
    frame = None
    for m, z in zs.items():
        rows = [(m, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), "d", v, 1.0) for i, v in enumerate(z)]
        one = spark.createDataFrame(rows, EV_DDL)
        frame = one if frame is None else frame.unionByName(one)
    dec, _ = apply_suppression(frame, prior, None, SuppressOptions(True, 0.3))
    for m, z in zs.items():
        assert decided(dec.filter(F.col("metric") == m)) == fold(z, 0.3, 4.0 if m == "b" else None)


def test_equal_times_are_decided_one_after_the_other(spark):
    at = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([("m", at, "d", 3.5, 1.0), ("m", at, "d", 3.6, 2.0), ("m", at, "d", 3.6, 2.0)], EV_DDL)
    dec, _ = apply_suppression(ev, None, None, SuppressOptions(True, 2.0))
    assert sorted(r.decision for r in dec.collect()) == ["new", "suppressed", "suppressed"]


def test_negative_delta_is_refused(spark):
    with pytest.raises(ValueError):
        apply_suppression(events(spark, "m", [3.5]), None, None, SuppressOptions(True, -0.1))
