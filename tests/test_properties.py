"""Randomised checks of the distributed operators against sequential references written
from the rules (brute force, small inputs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from tidewatch.operators.cooccur import co_occurrences
from tidewatch.operators.suppress import apply_suppression
from tidewatch.options import CoOccurrenceOptions, SuppressOptions

EV_DDL = "metric string, event_ts timestamp_ntz, timestamp string, z_score double, actual double"
ST_DDL = ("metric string, state string, last_alert_z double, last_alert_at string, "
          "last_value double, updated_at timestamp")


def reference_fold(zs, delta, state, last_z, points=None):
    """Sequential rules; ``points`` marks in-range observations (point scope)."""
    out = []
    for i, z in enumerate(zs):
        if points is not None and points[i]:
            if state == "active_anomaly":
                state, last_z = "normal", None
            continue
        az = abs(z)
        if state != "active_anomaly":
            state, last_z = "active_anomaly", az
            out.append("new")
        else:
            prev = abs(last_z) if last_z is not None else 0.0
            if az - prev >= delta:
                last_z = az
                out.append("escalation")
            else:
                last_z = prev
                out.append("suppressed")
    return out, state, last_z


series = st.lists(st.floats(3.0, 12.0) | st.floats(-12.0, -3.0), min_size=1, max_size=25)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(series, min_size=1, max_size=3), st.sampled_from([0.5, 1.0, 2.0, 3.5]),
       st.sampled_from([None, "normal", "active_anomaly"]), st.one_of(st.none(), st.floats(3, 9)))
def test_fold_matches_sequential_rules(spark, groups, delta, state0, z0):
    rows, want = [], {}
    for g, zs in enumerate(groups):
        m = f"m{g}"
        for i, z in enumerate(zs):
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
            rows.append((m, ts, ts.strftime("%Y-%m-%d"), float(z), float(i)))
        dec, _, lz = reference_fold(zs, delta, state0 or "normal", z0 if state0 else None)
        want[m] = (dec, lz)
    ev = spark.createDataFrame(rows, EV_DDL)
    prior = None
    if state0:
        prior = spark.createDataFrame(
            [(f"m{g}", state0, z0, "2023-12-31", 0.0, dt.datetime(2024, 1, 1))
             for g in range(len(groups))], ST_DDL)
    dec, new_state = apply_suppression(ev, prior, None, SuppressOptions(True, delta))
    got = {}
    for r in dec.collect():
        got.setdefault(r.metric, []).append((r.event_ts, r.decision))
    for m, (decisions, lz) in want.items():
        assert [d for _, d in sorted(got[m])] == decisions
    final = {r.metric: r.last_alert_z for r in new_state.collect()}
    for m, (_, lz) in want.items():
        assert abs(final[m] - lz) < 1e-12


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(st.booleans(), st.floats(3.0, 9.0)), min_size=2, max_size=30))
def test_point_scope_matches_sequential_rules(spark, marks):
    rows, ranges = [], []
    for i, (in_range, z) in enumerate(marks):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
        if in_range:
            ranges.append(("m", ts))
        else:
            rows.append(("m", ts, ts.strftime("%Y-%m-%d"), float(z), float(i)))
    if not rows:
        return
    want, _, _ = reference_fold([z for _, z in marks], 1.5, "normal", None,
                                points=[p for p, _ in marks])
    ev = spark.createDataFrame(rows, EV_DDL)
    in_range = spark.createDataFrame(ranges, "metric string, event_ts timestamp_ntz")
    dec, _ = apply_suppression(ev, None, None, SuppressOptions(True, 1.5, "point"),
                               in_range=in_range)
    assert [r.decision for r in dec.orderBy("event_ts").collect()] == want


def brute_co(anoms, n_days, strict):
    by_date = {}
    for m, d in anoms:
        by_date.setdefault(d, set()).add(m)
    if strict:
        out = {}
        for d in sorted(by_date):
            names = sorted(by_date[d])
            if len(names) >= 2:
                for n in names:
                    out[n] = [o for o in names if o != n]
        return out
    out = {}
    for m, d in set(anoms):
        near = set()
        for d2, names in by_date.items():
            if abs((d2 - d).days) <= n_days:
                near |= names
        out[(m, d)] = sorted(near - {m})
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(st.sampled_from("ABCDE"), st.integers(0, 20)), min_size=1,
                max_size=30), st.integers(0, 3), st.booleans())
def test_co_occurrence_matches_brute_force(spark, pairs, n_days, strict):
    anoms = [(m, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for m, d in pairs]
    df = spark.createDataFrame([(m, dt.datetime.combine(d, dt.time(12))) for m, d in anoms],
                               "metric string, timestamp timestamp_ntz")
    mode = "strict" if strict else "window"
    got_rows = co_occurrences(df, CoOccurrenceOptions(n_days, mode)).collect()
    if strict:
        got = {r.metric: r.others for r in got_rows}
    else:
        got = {(r.metric, r.date): r.others for r in got_rows}
    assert got == brute_co(anoms, n_days, strict)
