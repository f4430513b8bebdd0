"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage gets what the one before it kept, and returns the columns of ``documents`` (the
last one adds the token ids). Stages decide by row, not by doc_id, so rows that repeat a doc_id
are decided one by one. Null and empty texts are clean: nothing in them is toxic, repeated, near
another text or leaked, and they encode to no ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.bpe_codec import decode, encode
from tidewatch.llm.decontaminate import contaminated
from tidewatch.llm.line_dedup import line_dedup
from tidewatch.llm.ngram_jaccard import jaccard_classes
from tidewatch.llm.registry import BYTE_BPE_RANKS, TOXIC_SCORE, toxicity_model
from tidewatch.llm.toxicity import toxicity
from tidewatch.session import cut_lineage

def _free(docs: DataFrame, name: str) -> str:
    """``name``, with underscores after it until no column of ``docs`` is called that."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the rows of the numbers in ``rows.row``, the operators' row numbers."""
    number = _free(docs, "row")
    gone = cut_lineage(rows.select(F.col("row").alias(number)).distinct(), "pipeline-gone")
    return (docs.withColumn(number, F.monotonically_increasing_id())
            .join(gone, number, "left_anti").select(*docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels that are not held out."""
    score, margin = _free(docs, "score"), _free(docs, "margin")
    scored = toxicity(docs, toxicity_model(spark, sf_dir), keep=True, names=(score, margin))
    return scored.filter(F.col(score) < TOXIC_SCORE).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from the texts; a text that loses all of it goes as a whole.
    ``n_chars`` follows the text."""
    row, emptied, kept = (_free(docs, c) for c in ("row", "emptied", "kept"))
    changed = line_dedup(docs, changed=True).select(
        F.col("row").alias(row), (F.col("n_removed") == F.col("n_bytes")).alias(emptied),
        F.col("kept").cast("string").alias(kept))
    joined = docs.withColumn(row, F.monotonically_increasing_id()).join(changed, row, "left")
    text = F.coalesce(kept, "text")
    out = {"text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return joined.filter(~F.coalesce(emptied, F.lit(False))).select(
        *(out.get(c, F.col(c)).alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (and copies), the first row of each class stays."""
    return _without(docs, jaccard_classes(docs).filter("row <> class_row"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    return _without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With n_tokens and ids (little-endian unsigned 32-bit integers), in place of columns of
    those names. The ids are decoded again; a text that they don't give back stops the job."""
    docs = docs.drop("n_tokens", "ids", "decoded")
    # written between the two: a task that does both holds two Python workers at a time
    encoded = cut_lineage(encode(docs, BYTE_BPE_RANKS), "pipeline-ids")
    ids = decode(encoded, BYTE_BPE_RANKS)
    whole = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    checked = F.when(whole, F.col("ids")).otherwise(F.raise_error(F.lit("ids don't give the text back")))
    return ids.select(*docs.columns, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), checked.alias("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenized),
]

#: SQL cannot express the stages; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, over all documents; returns what the last one makes of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
