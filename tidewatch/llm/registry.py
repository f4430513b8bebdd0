"""The registered queries of the operators, over whole tables, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.bpe_codec import decode, encode
from tidewatch.llm.conversation_repair import damaged, repair
from tidewatch.llm.cross_align import cross_align
from tidewatch.llm.decontaminate import contaminated
from tidewatch.llm.line_dedup import line_dedup
from tidewatch.llm.ngram_jaccard import jaccard_classes
from tidewatch.llm.nn_descent import neighbours
from tidewatch.llm.sharding import shard_by_bytes
from tidewatch.llm.substring_dedup import substring_dedup
from tidewatch.llm.suffix_dedup import suffix_dedup
from tidewatch.llm.token_counts import token_counts
from tidewatch.llm.topk import top_k
from tidewatch.llm.toxicity import toxicity, train

BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Tokens above which op1 marks a document.
TOKEN_LIMIT = 512


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "start", "end", "edits")


#: Score from which op3 and the pipeline call a text toxic.
TOXIC_SCORE = 0.3


def held_out(doc_id):
    """Rows whose labels no model sees."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def toxicity_model(spark: SparkSession, sf_dir: str):
    labels = _table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    return train(_table(spark, sf_dir, "documents"), labels)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_classes(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "n_links")


OP4_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9_\\x{80}-\\x{10ffff}]+') AS words FROM documents
), g AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
                                 ELSE array_to_string(words[i:i + 4], ' ') END AS gram
    FROM w, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS t(i) WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), o AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_
    FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE both_ >= 0.8 * (x.n + y.n - both_) - 1e-9
), reach AS (
    SELECT a AS node, a AS root FROM links
    UNION SELECT links.b, reach.root FROM reach JOIN links ON reach.node = links.a
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node
), degree AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT d.doc_id, coalesce(r.root, d.doc_id) AS class_id, coalesce(k, 0) AS n_links
FROM documents d LEFT JOIN roots r ON r.node = d.doc_id LEFT JOIN degree ON degree.a = d.doc_id
"""


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50)


OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q,
           row_number() OVER () AS own
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS query_id, a.own AS query_row, b.vec_id,
           CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.own <> b.own
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 5
"""


def _digested(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(substring_dedup(_table(spark, sf_dir, "documents")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(line_dedup(_table(spark, sf_dir, "documents")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(suffix_dedup(_table(spark, sf_dir, "documents"), length=400))


OP8_SQL = """
WITH d AS (
    SELECT doc_id, row_number() OVER () AS own, hex(encode(coalesce(text, ''))) AS x,
           octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
), w AS (
    SELECT own, i, md5(substring(x, 2 * i + 1, 800)) AS s FROM d, unnest(generate_series(0, n - 400)) AS t(i)
), starts AS (
    SELECT own, i FROM w JOIN (SELECT s FROM w GROUP BY s HAVING count(*) > 1) USING (s)
), ends AS (
    SELECT own, i, lag(i + 400) OVER (PARTITION BY own ORDER BY i) AS before FROM starts
), runs AS (
    SELECT own, i, sum(CASE WHEN before IS NULL OR i > before THEN 1 ELSE 0 END)
        OVER (PARTITION BY own ORDER BY i) AS run
    FROM ends
), spans AS (SELECT own, run, min(i) AS a, max(i) + 400 AS b FROM runs GROUP BY own, run
), kept AS (
    SELECT own, b AS a, coalesce(lead(a) OVER (PARTITION BY own ORDER BY a), 1099511627776) AS b FROM spans
    UNION ALL SELECT own, 0, min(a) FROM spans GROUP BY own
), texts AS (
    SELECT own, string_agg(substring(x, 2 * a + 1, 2 * (least(b, n) - a)), '' ORDER BY a) AS x
    FROM kept JOIN d USING (own) GROUP BY own
), sums AS (SELECT own, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY own)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(texts.x, d.x))) AS kept_sha256
FROM d LEFT JOIN sums USING (own) LEFT JOIN texts USING (own)
"""


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(_table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE_RANKS).drop("text")
    return decode(ids, BYTE_BPE_RANKS).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = cross_align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op12_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(_table(spark, sf_dir, "embeddings"), k=10, every=100)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_exact_topk": op5_exact_topk,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sharding": op9_sharding,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_cross_align": op11_cross_align,
    "op12_nn_descent": op12_nn_descent,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLE_SQL = {"op4_ngram_jaccard": OP4_SQL, "op5_exact_topk": OP5_SQL, "op8_suffix_dedup": OP8_SQL}
