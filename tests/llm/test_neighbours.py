import numpy as np
import pytest

from tidewatch.llm import nn_descent as nn
from tidewatch.llm import registry
from tidewatch.session import cut_lineage

SCHEMA = "vec_id long, embedding array<float>, label int, v array<float>, node long, block long, q long, n long, ids string"


def table(spark, rows):
    """Written vectors beside columns of clashing names. ``rows``: (vec_id, vector)."""
    return cut_lineage(spark.createDataFrame([(i, v, 1, [1.0], 1, 1, 1, 1, "x") for i, v in rows], SCHEMA).coalesce(3), "v")


def brute(rows, k, every):
    """All distances in double precision: (query row's vec_id, its answers), sorted."""
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = []
    for own in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[own]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if j != own][:k]
        out.append((int(ids[own]), [(int(ids[j]), round(float(d[j]), 9)) for j in order]))
    return sorted(out)


def found(frame):
    by = {}
    for r in frame.collect():
        by.setdefault((r.query_id, r["rank"]), []).append((r.vec_id, round(r.score, 9)))
    return by


def recall(got, expected):
    hit = total = 0
    for query, answers in expected:
        mine = {x for (q, _), xs in got.items() if q == query for x in xs}
        hit += len(mine & set(answers))
        total += len(answers)
    return hit / total


def vectors(seed, n, width, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return [(int(i), (centres[i % 12] + spread * rng.normal(size=width)).astype(np.float32).tolist()) for i in range(n)]


def test_one_leaf_is_exact_with_copies_ties_and_odd_rows(spark):
    rows = vectors(1, 400, 8)
    rows += [(1000 + i, rows[5][1]) for i in range(60)] + [(1100, rows[7][1])] * 3 + [(5, rows[5][1])] * 2
    rows += [(2000, None), (2100, []), (2200, [0.0] * 8), (2300, [1.0, None, *[0.0] * 6]), (None, rows[3][1]),
             (2400, [float("nan")] * 8), (2500, [float("inf")] * 8), (2601, [1e30] * 8), (2700, [1e-30] * 8)]
    usual = [r for r in rows]
    got = found(nn.neighbours(table(spark, [*rows, (2800, [1.0, 2.0])]), 10, 50))
    want = {}
    for query, answers in brute(usual, 10, 50):
        for rank, a in enumerate(answers, 1):
            want.setdefault((query, rank), []).append(a)
    close = {key: [i for i, _ in sorted(v)] for key, v in got.items()}
    assert close == {key: [i for i, _ in sorted(v)] for key, v in want.items()}
    for key, v in want.items():
        assert np.allclose([d for _, d in sorted(v)], [d for _, d in sorted(got[key])], rtol=1e-9)


@pytest.mark.parametrize(("leaf", "block"), [(200, 500), (100, 10_000)])
def test_rounds_and_hops_reach_recall(spark, monkeypatch, leaf, block):
    """Many leaves and blocks: what a leaf doesn't hold is found by rounds of NN-descent and the search."""
    rows = vectors(2, 3000, 16, 1.0)
    for name, value in (("LEAF", leaf), ("BLOCK", block), ("GROUP", 300), ("BEAM", 64), ("OPENED", 32)):
        monkeypatch.setattr(nn, name, value)
    expected = brute(rows, 10, 100)
    got = found(nn.neighbours(table(spark, rows)))
    assert recall(got, expected) >= 0.9
    assert all(len(v) == 1 for v in got.values()) and len(got) == 300
    monkeypatch.setattr(nn, "ROUNDS", 0)
    monkeypatch.setattr(nn, "HOPS", 0)
    assert recall(found(nn.neighbours(table(spark, rows))), expected) < recall(got, expected)


def test_result_does_not_follow_the_splits(spark, monkeypatch):
    for name, value in (("LEAF", 200), ("BLOCK", 500), ("GROUP", 300), ("BEAM", 64)):
        monkeypatch.setattr(nn, name, value)
    rows = vectors(3, 1500, 8)
    one = found(nn.neighbours(table(spark, rows).repartition(7, "vec_id")))
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert found(nn.neighbours(table(spark, rows[::-1]).coalesce(1))) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_few_rows_none_and_no_query(spark):
    assert nn.neighbours(table(spark, [])).count() == 0
    assert nn.neighbours(table(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0])])).count() == 0
    assert nn.neighbours(table(spark, [(100, [1.0, 2.0])])).count() == 0
    got = nn.neighbours(table(spark, [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (3, [4.0, 6.0])])).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (100, 1, 100, 0.0), (100, 1, 100, 0.0), (100, 2, 3, 5.0), (100, 2, 3, 5.0)]


def test_whole_query_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = found(registry.op12_nn_descent(spark, sf_dir))
    assert recall({(q, k): v for (q, k), v in got.items()}, brute(rows, 10, 100)) >= 0.9
