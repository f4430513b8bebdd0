import random

import duckdb
import numpy as np
import pytest
from tests.llm.samples import ODD, table

from tidewatch.llm import decontaminate as leaks
from tidewatch.llm import registry
from tidewatch.llm.components import components
from tidewatch.llm.ngram_jaccard import jaccard_classes, run_count
from tidewatch.llm.topk import top_k
from tidewatch.session import cut_lineage


def sellers(pattern, text):
    """The fewest edits between the pattern and any piece of the text."""
    col = list(range(len(pattern) + 1))
    best = col[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(pattern):
            new.append(min(col[i] + (x != c), col[i + 1] + 1, new[i] + 1))
        col, best = new, min(best, new[-1])
    return best


def test_leaks_against_edit_distances():
    rng = random.Random(3)
    words = ["alpha", "beta", "gam", "the", "of", "in", "thing", "er", "on"]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(3, 30))).encode()) for k in range(20)]
    index = leaks.Index(items, 0.1)
    found = 0
    for _ in range(15):
        texts = []
        for _ in range(3):
            around = " ".join(rng.choice(words) for _ in range(rng.randint(0, 20))).encode()
            piece = bytearray(rng.choice(items)[1])
            for _ in range(rng.randint(0, leaks.budget(len(piece)) + 2)):
                at = rng.randrange(len(piece))
                piece[at:at + rng.randint(0, 1)] = rng.choice((b"", b"x"))
            texts.append(around + b" " + bytes(piece) + b" " + around)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = leaks.occurrences(index, np.frombuffer(b"".join(texts), np.uint8), off)
        for d, text in enumerate(texts):
            for k, (_, item) in enumerate(items):
                if len(item) >= leaks.Q:
                    edits = sellers(item, text)
                    assert (got[d, k][0] if (d, k) in got else None) == (edits if edits <= index.budget[k] else None)
                    found += (d, k) in got
    assert found > 20


def test_leaks_of_odd_rows(spark, odd, none):
    items = [(1, "A twin text that is here two times"), (2, None), (3, "word"), (4, ""), (5, "NOBODY knows; why!")]
    benchmark = cut_lineage(spark.createDataFrame(items, "item_id long, text string"), "items")
    for block in (1 << 20, 20):                    # one block of items, and several
        hits = leaks.contaminated(odd, benchmark, block_bytes=block).collect()
        assert sorted((r.doc_id, r.item_id) for r in hits) == [(4, 5), (6, 1), (6, 1), (10, 5)]
    texts = dict((i, t) for i, t in ODD if t)
    assert {texts[r.doc_id].encode()[r.start:r.end] for r in hits} == {b"A twin text that is here two times", b"nobody knows why"[:0] or b"nobody knows why"}
    assert leaks.contaminated(none, benchmark).count() == 0
    assert leaks.contaminated(odd, benchmark.limit(0)).count() == 0


def test_op2_query_finds_every_whole_item(spark, sf_dir):
    fold = lambda t: b" ".join(leaks.FOLD[np.frombuffer(t.encode(), np.uint8)].tobytes().split())
    docs = {r.doc_id: fold(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: fold(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, item in items.items() if item in t}
    got = {(r.doc_id, r.item_id): r.edits for r in registry.op2_decontamination(spark, sf_dir).collect()}
    assert whole == {k for k, edits in got.items() if edits == 0} and whole
    for (d, i), edits in got.items():
        assert sellers(items[i], docs[d]) == edits if edits else True


def classes_by_brute_force(texts, threshold=0.8):
    import re
    sets = []
    for t in texts:
        words = re.findall("[a-z0-9_\x80-\U0010ffff]+", (t or "").lower())
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    links = [[j for j in range(len(sets)) if j != i and sets[i] and sets[j]
              and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9] for i in range(len(sets))]
    label = list(range(len(sets)))
    while (new := [min([label[i], *(label[j] for j in links[i])]) for i in range(len(sets))]) != label:
        label = new
    return label, [len(x) for x in links]


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    from tidewatch.llm import ngram_jaccard
    monkeypatch.setattr(ngram_jaccard, "BUCKET", 8)         # so that buckets split, and blocks are paired
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 8)
    monkeypatch.setattr(ngram_jaccard, "LAST_BLOCK", 8)
    rng = random.Random(9)
    base = [[str(rng.randrange(1000)) for _ in range(rng.randint(60, 120))] for _ in range(6)]
    texts = []
    for k in range(90):
        words = list(base[k % 6 if k % 3 else 0])
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = str(rng.randrange(1000))
        texts.append(" ".join(words))
    texts += [texts[3], "a b c", "A, b; c", "a b c d", "", "..."]
    rows = table(spark, list(enumerate(texts)))
    got = sorted((r.doc_id, r.class_row, r.class_id, r.n_links) for r in jaccard_classes(rows).collect())
    label, links = classes_by_brute_force(texts)
    assert [g[3] for g in got] == links
    own = {}
    for i, _, class_id, _ in got:
        own.setdefault(class_id, set()).add(i)
    expected = {}
    for i, x in enumerate(label):
        expected.setdefault(x, set()).add(i)
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, expected.values()))
    assert all(c in members for c, members in own.items())


def test_runs_reach_the_recall():
    assert run_count(0.8, 1, 0.84) == 1 and run_count(0.8, 4, 0.9999) > 8


def test_classes_of_odd_rows(odd, none):
    got = sorted(((r.doc_id, r.n_links) for r in jaccard_classes(odd).collect()), key=str)
    assert got == sorted([(i, 1 if i in (4, 6, 10) else 0) for i, _ in ODD], key=str)
    assert jaccard_classes(none).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def by_brute_force(rows, k, every):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(ok):
        if i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(ok) if a != b)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_against_brute_force(spark, monkeypatch):
    from tidewatch.llm import topk
    monkeypatch.setattr(topk, "LEAF", 4)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=6).round(1))]) for i in rng.integers(0, 200, 300)]
    rows += [(0, None), (10, [1.0, None]), (10, [float("nan")]), (20, [float("inf")] * 6), (None, [1.0] * 6),
             (30, []), (40, [1.0, 2.0]), (50, [1e6] * 6), (60, [-1e6, 1e6])]
    table_ = cut_lineage(spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                                               "vec_id long, embedding array<float>, shard int, ids int"), "vectors")
    rows = [(r.vec_id, r.embedding) for r in table_.collect()]
    got = sorted(map(tuple, top_k(table_, 5, 10).collect()))
    assert got == by_brute_force(rows, 5, 10)
    assert top_k(table_.limit(0)).count() == 0
    few = table_.filter("vec_id = 40 or vec_id = 30")
    assert sorted(map(tuple, top_k(few, 5, 10).collect())) == by_brute_force(
        [(r.vec_id, r.embedding) for r in few.collect()], 5, 10)


@pytest.mark.parametrize("name", ["op4_ngram_jaccard", "op5_exact_topk", "op8_suffix_dedup"])
def test_queries_with_sql(spark, sf_dir, name):
    for t in ("documents", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = duckdb.sql(registry.ORACLE_SQL[name])
    got = registry.QUERIES[name](spark, sf_dir).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
