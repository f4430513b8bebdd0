import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tidewatch.operators.halo import halo_rolling_stats, series_positions
from tidewatch.operators.ranking import global_row_number, top_per_series
from tidewatch.operators.rolling import rolling_stats
from tidewatch.options import DetectOptions


def long_frame(spark, n=400, series=3, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(series):
        for i in range(n - 37 * s):
            v = None if rng.random() < 0.05 else float(rng.normal(10 * s, 1 + s))
            rows.append((f"m{s}", i, v))
    return spark.createDataFrame(rows, "metric string, i long, value double").select(
        "metric", F.timestamp_seconds(F.col("i") * 3600).cast("timestamp_ntz").alias("ts"),
        "value")


def test_series_positions_match_row_number(spark):
    df = long_frame(spark)
    pos = series_positions(df, num_partitions=7)
    w = Window.partitionBy("metric").orderBy("ts")
    ref = df.withColumn("rn", F.row_number().over(w) - 1)
    diff = pos.join(ref, ["metric", "ts"]).filter(F.col("pos") != F.col("rn")).count()
    assert diff == 0 and pos.count() == df.count()


@settings(max_examples=4, deadline=None)
@given(st.integers(29, 150))
def test_halo_equals_plain(spark, chunk):
    df = long_frame(spark, 300, 2, seed=chunk)
    plain = rolling_stats(df, DetectOptions(window_size=30))
    halo = halo_rolling_stats(df, DetectOptions(window_size=30, chunk_rows=chunk))
    a = {(r.metric, r.ts): (r.n_obs, r.rolling_mean, r.rolling_std) for r in plain.collect()}
    b = {(r.metric, r.ts): (r.n_obs, r.rolling_mean, r.rolling_std) for r in halo.collect()}
    assert a.keys() == b.keys()
    for k, (n, m, s) in a.items():
        n2, m2, s2 = b[k]
        assert n == n2
        assert (m is None and m2 is None) or abs(m - m2) < 1e-9
        assert (s is None and s2 is None) or abs(s - s2) < 1e-9


def test_global_row_number(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    out = global_row_number(df, [F.col("k").desc()], num_partitions=5)
    rows = out.collect()
    assert sorted(r.row_no for r in rows) == list(range(1, 1001))
    assert all(r.row_no == 1000 - r.k for r in rows)


def test_top_per_series(spark):
    rows = [("a", i, float(i % 7)) for i in range(30)] + [("b", i, float(-i)) for i in range(5)]
    df = spark.createDataFrame(rows, "metric string, timestamp long, z_score double")
    out = top_per_series(df, 2, F.abs(F.col("z_score"))).collect()
    got = sorted((r.metric, r.timestamp) for r in out)
    assert got == [("a", 6), ("a", 13), ("b", 3), ("b", 4)]


def test_hot_series_split_equals_plain(spark):
    df = long_frame(spark, 400, 3, seed=3)          # series of 400, 363 and 326 rows
    plain = rolling_stats(df, DetectOptions(window_size=30)).collect()
    from tidewatch.operators.rolling import split_hot_rolling_stats
    split = split_hot_rolling_stats(df, DetectOptions(window_size=30, hot_series_rows=350))
    assert "pos" not in split.columns
    got = {(r.metric, r.ts): (r.n_obs, r.rolling_mean, r.rolling_std, r.z) for r in split.collect()}
    assert len(got) == len(plain)
    for r in plain:
        g = got[(r.metric, r.ts)]
        assert g[0] == r.n_obs
        for a, b in zip(g[1:], (r.rolling_mean, r.rolling_std, r.z)):
            assert (a is None and b is None) or abs(a - b) < 1e-9
