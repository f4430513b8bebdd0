import numpy as np
import pyarrow as pa

import corpus_pipeline as pipeline
from tests.llm.samples import ODD, table
from tests.llm.test_search import classes_by_brute_force

from tidewatch.llm import arrow, registry, toxicity
from tidewatch.llm import decontaminate as leaks
from tidewatch.llm.bpe_codec import encode
from tidewatch.llm.line_dedup import line_chunks
from tidewatch.session import cut_lineage


def test_stages_take_odd_rows(spark, sf_dir, odd, none):
    for docs in (odd, none):
        columns = docs.columns
        for name, stage in pipeline.STAGES:
            docs = cut_lineage(stage(spark, docs, sf_dir), f"odd-{name}")
            if name != "byte_bpe":
                assert docs.columns == columns
        assert {"n_tokens", "ids", "text", "lang"} <= set(docs.columns)
    assert odd.count() == len(ODD)


def test_run_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scores = {r.doc_id: r.predicted for r in registry.op3_toxicity(spark, sf_dir).collect()}
    rows = [(r.doc_id, r.text) for r in docs.coalesce(1).collect() if not scores[r.doc_id]]
    seen, kept = set(), []
    for i, t in rows:
        text, out, at = t.encode(), b"", 0
        for a, b in line_chunks(text):
            chunk = text[a:b].removesuffix(b"\n")
            if chunk in seen:
                out, at = out + text[at:a], b
            seen.add(chunk)
        out += text[at:]
        if out or not text:
            kept.append((i, out.decode()))
    label, _ = classes_by_brute_force([t for _, t in kept])
    groups = {}
    for k, x in enumerate(label):
        groups.setdefault(x, set()).add(kept[k])
    got = pipeline.run(spark, sf_dir)
    final = {r.doc_id: r for r in got.collect()}
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = {r.doc_id for r in leaks.contaminated(table(spark, kept), benchmark).collect()}
    for members in groups.values():
        here = [(i, t) for i, t in members if i in final]
        assert len(here) == (0 if not here and any(i in leaked for i, _ in members) else 1)
        for i, t in here:
            assert i not in leaked and final[i].text == t and final[i].n_chars == len(t)
    assert len(final) == got.count()


def test_a_task_of_a_stage_holds_one_python_worker(spark, sf_dir, odd):
    for name, stage in pipeline.STAGES:
        out = stage(spark, odd, sf_dir)
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1, name
    assert out.count() == odd.count()


def test_a_worker_keeps_what_one_stage_has_looked_up(spark, odd, monkeypatch):
    monkeypatch.setattr(arrow, "_KEPT", {})
    first = arrow.kept("one", dict)
    first["x"] = 1
    assert arrow.kept("one", dict) is first
    assert arrow.kept("other", dict) == {} and list(arrow._KEPT) == ["other"]

    docs, model = odd.select("doc_id", "text"), toxicity.Model(np.zeros(toxicity.CLASSES**3), 0.0)

    def left(batches):
        from tidewatch.llm.arrow import _KEPT
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"keys": [str(list(_KEPT))] * batch.num_rows})

    toxicity.toxicity(docs, model).coalesce(1).collect()
    encode(docs, registry.BYTE_BPE_RANKS).coalesce(1).collect()
    seen = {r.keys for r in docs.coalesce(1).mapInArrow(left, "keys string").collect()}
    assert not any("margins" in k and "encoder" in k for k in seen)
