import random

import numpy as np
from tests.llm.samples import ODD, table

from tidewatch.llm import registry
from tidewatch.llm import toxicity as tox
from tidewatch.session import cut_lineage


def kernel(s, t):
    """The normalised gap-weighted kernel, by definition."""
    def feats(w):
        out = {}
        c = tox.CLASS_OF[[ord(x) for x in w]]
        for i in range(len(c)):
            for j in range(i + 1, len(c)):
                for k in range(j + 1, min(len(c), i + tox.SPAN)):
                    if c[i] and c[j] and c[k]:
                        key = (c[i], c[j], c[k])
                        out[key] = out.get(key, 0) + tox.DECAY ** (k - i + 1)
        return out
    a, b = feats(s), feats(t)
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    return dot(a, b) / max((dot(a, a) * dot(b, b)) ** 0.5, 1e-9)


def test_gram_is_the_subsequence_kernel():
    words = ["idiot", "i.d.i.o.t", "idiotic", "banana", "aaaa", "th", "worthless"]
    z = tox.features(words)
    got = tox.gram(z, z)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(got[i, j] - kernel(a, b)) < 1e-9


def test_margins_are_the_sum_over_landmarks():
    toxic, clean = ["idiot", "moron", "scum"], ["the", "table", "onion", "motion", "scoop", "idol"] * 3
    model = tox.fit_units(toxic, clean, np.ones(3))
    margins = model.margins([*toxic, "idxiot", "table", "", "th", "x" * 100 + "idiot" + "y" * 100])
    assert margins[:4].min() > 0 > margins[4] and (margins[5:7] == tox.FLOOR).all()


def corpus(spark, n=240):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(("ta", "no", "ri", "sel", "um", "de")) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(("blockhead", "nitwit", "scoundrel"))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (0, 1, None), (999, 0, 1)]
    return table(spark, docs), cut_lineage(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")


def test_learns_words_and_their_disguises(spark, odd, none):
    docs, labels = corpus(spark)
    model = tox.train(docs, labels)
    got = {r.doc_id: r.score for r in tox.toxicity(docs, model).collect()}
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in got)
    new = [(1, "a n.i.t.w.i.t here"), (2, "such a b l o c k h e a d he is"), (3, "scoundxrel"), (4, "tano rita umde sel"),
           (5, "NITWIT!"), (6, "scoundrels")]
    scored = {r.doc_id: r.score for r in tox.toxicity(table(spark, new), model).collect()}
    assert [scored[i] >= 0.3 for i in range(1, 7)] == [True, True, True, False, True, True]
    rows = tox.toxicity(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert tox.toxicity(none, model).count() == 0


def test_one_label_or_none(spark, odd):
    docs, labels = corpus(spark, 40)
    assert tox.train(docs, labels.filter("toxic = 1")) == 1.0
    assert tox.train(docs, labels.filter("toxic = 0")) == 0.0
    assert tox.train(docs, labels.limit(0)) == 0.0
    assert {r.score for r in tox.toxicity(odd, 0.0).collect()} == {0.0}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in registry.op3_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows)
    assert right > 0.93                                    # some of the labels are wrong on purpose


def test_learns_insults_that_share_documents(spark):
    docs, labels = corpus(spark)
    extra = {i: " blockhead" + (" zanyjerk" if i % 24 == 0 else "") for i in range(0, 240, 4)}
    docs = table(spark, [(r.doc_id, r.text + extra.get(r.doc_id, "")) for r in docs.collect()], "shared")
    model = tox.train(docs, labels)
    scored = tox.toxicity(table(spark, [(1, "a zanyjerk here"), (2, "you blockhead"), (3, "tano rita umde sel")]), model)
    assert {r.doc_id: r.score >= 0.3 for r in scored.collect()} == {1: True, 2: True, 3: False}


def test_few_toxic_documents_make_a_model(spark):
    docs, labels = corpus(spark, 8)
    assert isinstance(tox.train(docs, labels), tox.Model)


def test_telling_counts_chance_finds():
    rare = {(1, 0): 400, (0, 1): 4000, (3, 30): 50, (0, 9): 100}
    assert set(tox.telling({**rare, (8, 0): 10, (20, 1): 2}, 36, 260)) == {(8, 0), (20, 1)}
    assert set(tox.telling({(2, 0): 3, (1, 0): 90, (0, 1): 300}, 9, 54)) == {(2, 0)}
    assert tox.telling({(0, 2): 5}, 3, 5) == {}
