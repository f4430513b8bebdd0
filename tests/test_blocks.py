import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import blocks
from tidewatch.operators.blocks import blocked_rolling_stats
from tidewatch.operators.cooccur import co_occurrences
from tidewatch.operators.rolling import rolling_stats
from tidewatch.options import CoOccurrenceOptions, DetectOptions


def series(spark, lengths, offset=0.0, seed=5, nulls=0.1):
    rng = np.random.default_rng(seed)
    rows = []
    for m, n in enumerate(lengths):
        for i in range(n):
            value = None if rng.random() < nulls else float(offset + rng.normal() * 3)
            rows.append((f"m{m}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), value))
    return spark.createDataFrame(rows, "metric string, ts timestamp_ntz, value double")


@pytest.mark.parametrize(("window", "least"), [(2, 1), (7, 3), (40, 40), (64, 5)])
@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_blocks_equal_sliding_frames(spark, window, least, offset):
    long = series(spark, [1, 6, 40, 150, 333], offset)
    opts = DetectOptions(window_size=window, min_periods=least)
    a = rolling_stats(long, opts).orderBy("metric", "ts").collect()
    b = blocked_rolling_stats(long, opts).orderBy("metric", "ts").collect()
    assert [r.n_obs for r in a] == [r.n_obs for r in b] and len(a) == 530
    for x, y in zip(a, b):
        # values near 1e9 carry about 1e-7 themselves
        for p, q, off in ((x.rolling_mean, y.rolling_mean, 1e-9 * max(1.0, offset)),
                          (x.rolling_std, y.rolling_std, 1e-6 if offset else 1e-9)):
            assert (p is None) == (q is None) and (p is None or abs(p - q) <= off)


def test_a_constant_series_has_no_score(spark):
    long = spark.createDataFrame([("m", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 0.1) for i in range(90)],
                                 "metric string, ts timestamp_ntz, value double")
    out = blocked_rolling_stats(long, DetectOptions(window_size=20))
    assert out.filter(F.col("z").isNotNull()).count() == 0
    assert out.filter((F.col("rolling_std") != 0) & F.col("rolling_std").isNotNull()).count() == 0


def test_large_windows_take_blocks_and_one_shuffle(spark, monkeypatch):
    long = series(spark, [80, 90])
    monkeypatch.setattr(blocks, "LARGE_WINDOW", 10)
    plan = rolling_stats(long, DetectOptions(window_size=30))._jdf.queryExecution().executedPlan().toString()
    assert "lag(" in plan and plan.count("Exchange hashpartitioning") == 1


def test_cost_does_not_grow_with_the_window(spark):
    long = spark.range(200_000).select(F.lit("m").alias("metric"), F.col("id").alias("ts"), F.rand(3).alias("value"))
    took = {}
    for window in (300, 10_000):
        for _ in range(2):
            start = time.time()
            rolling_stats(long, DetectOptions(window_size=window)).write.format("noop").mode("overwrite").save()
            took[window] = time.time() - start
    assert took[10_000] < 3 * took[300] + 1


@pytest.mark.parametrize("days", [1, 2, 7, 60])
def test_date_bins_equal_all_dates_in_reach(spark, days):
    rng = np.random.default_rng(days)
    rows = sorted({(str(rng.choice(["x", "y"])), f"m{rng.integers(5)}", dt.date(1969, 11, 1) + dt.timedelta(days=int(d)))
                   for d in rng.integers(0, 200, 60)})
    frame = spark.createDataFrame(rows, "entity string, metric string, timestamp date")
    got = {(r.entity, r.metric, r.date): r.others for r in
           co_occurrences(frame, CoOccurrenceOptions(days, "window"), ["entity"]).collect()}
    assert got == {(e, m, d): sorted({n for f, n, x in rows if f == e and n != m and abs((x - d).days) <= days})
                   for e, m, d in rows}
