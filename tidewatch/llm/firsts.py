"""Which chunk of a digest is the first, whatever the scan's splits are.

The order of chunks is that of their rows' doc_id (null: before all), then of the hash of the
text, then of the place in the text. Row numbers, which follow the splits, only tell apart rows
that are equal, so that the texts kept do not depend on how the table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.skew import attach
from tidewatch.session import cut_lineage

#: Stands for a null doc_id, which sorts before all others.
LOWEST = -(1 << 63)


def place() -> F.Column:
    """The column ``doc`` by which chunks are ordered first."""
    return F.coalesce(F.col("doc_id"), F.lit(LOWEST)).alias("doc")


def later(rows: DataFrame, again: DataFrame, keys: list[str]) -> DataFrame:
    """The chunks of ``again`` that are not the first of their digest.

    ``rows``: row, doc_id, text. ``again``: keys, row, doc, own (the same text has the chunk
    before) and first, the smallest doc of the digest. Where a doc_id has one row, doc and own
    decide. Rows that share a doc_id are compared by the hashes of their texts: one
    aggregate for each digest, combined before it is shuffled.
    """
    ids = rows.select("row", place(), F.xxhash64("text").alias("hash"))
    shared = cut_lineage(ids.groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1"), "shared-ids")
    if shared.isEmpty():
        return again.filter("own or doc > first")
    again = cut_lineage(again, "shared-chunks")
    behind = again.filter("own or doc > first")
    hashes = cut_lineage(attach(ids, shared, ["doc"]).select("row", "hash"), "shared-rows")
    tied = again.filter("not own and doc = first").join(hashes, "row").withColumn("order", F.struct("hash", "row"))
    tied = cut_lineage(tied, "tied-chunks")
    heads = tied.groupBy(*keys).agg(F.count("*").alias("n"), F.min("order").alias("head")).filter("n > 1")
    rest = attach(tied, cut_lineage(heads, "tied-heads"), keys).filter("order > head")
    return behind.unionByName(rest.select(*behind.columns))
