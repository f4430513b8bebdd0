"""Rows must not depend on how the scan cuts and packs files."""

import pytest

from tidewatch.llm.line_dedup import line_dedup
from tidewatch.llm.ngram_jaccard import jaccard_classes
from tidewatch.llm.substring_dedup import substring_dedup

SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(scope="module")
def many_files(spark, sf_dir, tmp_path_factory):
    """Documents in files of different sizes, some doc_ids with several rows, equal and unequal."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(5, rows[9][1]), (5, rows[9][1]), (9, rows[5][1]), (None, rows[20][1]), (None, rows[20][1]),
             (5, rows[30][1] + "\nand\nmore lines\nthan there")]
    base = str(tmp_path_factory.mktemp("splits") / "documents")
    cuts = [0, 3, 90, 100, 160, len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        spark.createDataFrame(rows[a:b], "doc_id long, text string").coalesce(1).write.mode("append").parquet(base)
    return base


@pytest.mark.parametrize("operator", [substring_dedup, line_dedup, jaccard_classes])
def test_rows_do_not_follow_the_splits(spark, many_files, operator):
    before, seen = spark.conf.get(SIZE), []
    try:
        for size in ("128m", "8k"):
            spark.conf.set(SIZE, size)
            out = operator(spark.read.parquet(many_files))
            got = out.drop("row", "class_row").collect()
            seen.append(sorted(tuple(-1 if v is None else v for v in r) for r in got))
    finally:
        spark.conf.set(SIZE, before)
    assert seen[0] == seen[1]
