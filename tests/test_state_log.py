import pytest
from pyspark.sql import functions as F

from tidewatch.sources import state_log as log

DDL = "nation string, metric string, state string, last_alert_z double, last_alert_at string, last_value double, updated_at timestamp"
KEYS = ["nation"]


def table(spark, rows):
    full = [(n, m, "normal" if z is None else "active_anomaly", z, None, 1.0, None) for n, m, z in rows]
    return spark.createDataFrame(full, DDL)


def facts(df):
    return sorted((r.nation, r.metric, r.last_alert_z) for r in df.collect())


def part_rows(spark, base, version):
    return spark.read.parquet(f"{base}/{log.log_entry(spark, base, version)['parts'][-1]}").count()


def test_a_run_writes_the_rows_that_it_changed(spark, tmp_dir):
    base = f"{tmp_dir}/state"
    assert log.log_version(spark, base) == 0
    assert log.read_log(spark, base, KEYS, "nation string").count() == 0
    rows = {(f"n{k}", m): float(k) if k % 3 else None for k in range(200) for m in ("a", "b")}
    rows[None, "a"] = 3.0                                     # a null key is a series too
    whole = [dict(rows)]
    for run in range(7):
        assert log.commit_state(table(spark, [(*k, z) for k, z in rows.items()]), base, f"run-{run}", run, KEYS,
                                compact_after=3) == run + 1
        whole.append(dict(rows))
        rows[f"n{run}", "a"] = 100.0 + run                    # changed, new, reset, unchanged
        rows[f"new{run}", "a"] = None
        rows[f"n{run + 50}", "b"] = None
    for version in range(1, 8):
        expected = {tuple(k): z for k, z in whole[version].items()}
        got = {(r.nation, r.metric): r.last_alert_z for r in log.read_log(spark, base, KEYS, version=version).collect()}
        assert got == expected
        parts = log.log_entry(spark, base, version)["parts"]
        assert len(parts) <= 4
        if len(parts) > 1:
            assert part_rows(spark, base, version) <= 3
    assert len(log.log_entry(spark, base, 5)["parts"]) == 1   # compacted
    assert part_rows(spark, base, 5) == len(whole[5])


def test_a_run_without_changes_writes_no_rows_and_missing_series_stay(spark, tmp_dir):
    base = f"{tmp_dir}/state"
    first = table(spark, [("x", "a", 3.0), ("x", "b", None)])
    log.commit_state(first, base, "1", 0, KEYS)
    log.commit_state(first, base, "2", 1, KEYS)
    assert part_rows(spark, base, 2) == 0
    log.commit_state(first.filter("metric = 'a'").withColumn("last_alert_z", F.lit(4.0)), base, "3", 2, KEYS)
    assert facts(log.read_log(spark, base, KEYS)) == [("x", "a", 4.0), ("x", "b", None)]


@pytest.mark.parametrize("race", [False, True])
def test_of_two_writers_one_is_refused(spark, tmp_dir, monkeypatch, race):
    base = f"{tmp_dir}/state"
    log.commit_state(table(spark, [("x", "a", 3.0)]), base, "1", 0, KEYS)
    log.commit_state(table(spark, [("x", "a", 5.0)]), base, "left", 1, KEYS)
    if race:      # the other one published after this one had looked
        monkeypatch.setattr(log, "_is_replay", lambda *a: False)
    with pytest.raises(log.StateConflict):
        log.commit_state(table(spark, [("x", "a", 7.0)]), base, "right", 1, KEYS)
    assert log.log_version(spark, base) == 2
    assert facts(log.read_log(spark, base, KEYS)) == [("x", "a", 5.0)]


def test_a_repeated_run_changes_nothing(spark, tmp_dir):
    base = f"{tmp_dir}/state"
    log.commit_state(table(spark, [("x", "a", 3.0)]), base, "1", 0, KEYS)
    log.commit_state(table(spark, [("x", "a", 5.0)]), base, "2", 1, KEYS)
    assert log.version_before(spark, base, "2") == 1 and log.version_before(spark, base, "3") == 2
    assert log.commit_state(table(spark, [("x", "a", 9.0)]), base, "2", 1, KEYS) == 2
    assert facts(log.read_log(spark, base, KEYS)) == [("x", "a", 5.0)]
