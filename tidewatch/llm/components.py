"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) for all nodes of edges (a, b).

    In each round every node takes the name of its smallest neighbour, if that is smaller;
    edges whose ends then have one name vanish. The names of all rounds are put together at the
    end. Sums over neighbours are combined before they are shuffled, and nothing is collected.
    """
    both = edges.filter("a <> b").select("a", "b")
    both = cut_lineage(both.unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    named = []
    while not both.isEmpty():
        name = both.groupBy("a").agg(F.min("b").alias("b"))
        name = cut_lineage(name.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "names")
        named.append(name)
        left = both.join(name.withColumnsRenamed({"node": "a", "label": "x"}), "a")
        ends = left.join(name.withColumnsRenamed({"node": "b", "label": "y"}), "b")
        both = cut_lineage(ends.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    if not named:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0)
    out = named[0]
    for name in named[1:]:
        then = name.select(F.col("node").alias("label"), F.col("label").alias("then"))
        out = out.join(then, "label", "left").select("node", F.coalesce("then", "label").alias("label"))
    return cut_lineage(out, "components")
