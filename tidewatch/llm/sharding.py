"""Operator 9: sharding by minimax contiguous partition.

Groups of equal texts are atoms; their order is that of the texts' SHA-256 digests. The
smallest shard capacity for which a greedy pass over the ordered atoms needs no more than the
given number of shards is found by binary search, and the shards are cut where that pass cuts.

The driver never holds the atoms. It searches on a histogram of digest prefixes (65,536 at
first): the greedy pass for the lowest and the highest capacity in question shows in which
prefixes a cut can fall, those alone are split by longer prefixes, and so on until each holds
one atom. The result is the exact optimum over atoms.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

#: Hexadecimal digits of the first histogram, and those that each further one adds.
FIRST_DIGITS, MORE_DIGITS = 4, 2


def greedy(sizes: list[int], prefix: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cuts (indexes at which a shard starts, without the first), or None if they don't suffice.

    ``prefix[k]`` is the sum of the first k sizes.
    """
    at, cuts = 0, []
    while True:
        to = bisect_right(prefix, prefix[at] + capacity) - 1
        if to >= len(sizes):
            return cuts
        if to == at or len(cuts) + 1 == shards:
            return None
        cuts.append(to)
        at = to


def smallest_capacity(sizes: list[int], shards: int, least: int = 0) -> tuple[int, list[int]]:
    """The smallest capacity of at least ``least`` that suffices, and its cuts."""
    prefix = [0, *accumulate(sizes)]
    low = max(least, -(-prefix[-1] // shards), max(sizes, default=0))
    high = max(low, prefix[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy(sizes, prefix, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low, greedy(sizes, prefix, low, shards) or []


def _histogram(groups: DataFrame, digits: int) -> list[tuple[str, int, int, int]]:
    prefix = F.substring("digest", 1, digits).alias("prefix")
    rows = groups.groupBy(prefix).agg(F.sum("size").alias("size"), F.max("size").alias("most"),
                                      F.count("*").alias("n")).collect()
    return [tuple(r) for r in rows]


def cut_points(groups: DataFrame, shards: int) -> list[str]:
    """The digest prefixes at which the second and further shards start.

    ``groups``: ``digest`` (hexadecimal) and ``size`` of every atom.
    """
    digits = FIRST_DIGITS
    cells = sorted(_histogram(groups, digits))
    while True:
        sizes = [c[1] for c in cells]
        prefix = [0, *accumulate(sizes)]
        least = max([-(-prefix[-1] // shards), *(c[2] for c in cells)])
        most, cuts = smallest_capacity(sizes, shards, least)   # cells as atoms: feasible
        open_: set[int] = set()
        low = high = 0                    # where a cut can be, at the earliest and the latest
        for _ in range(shards - 1):
            low = max(low, bisect_right(prefix, prefix[low] + least) - 1)
            high = min(len(cells), bisect_right(prefix, prefix[high] + most))
            open_.update(k for k in range(low, min(high + 1, len(cells))) if cells[k][3] > 1)
        if not open_:
            return [cells[k][0] for k in cuts]
        digits += MORE_DIGITS
        split = [cells[k][0] for k in sorted(open_)]
        inside = groups.filter(_starts_with(split))
        cells = sorted([c for k, c in enumerate(cells) if k not in open_] + _histogram(inside, digits))


def _starts_with(prefixes: list[str]):
    found = F.lit(False)
    for length in sorted({len(p) for p in prefixes}):
        found |= F.substring("digest", 1, length).isin([p for p in prefixes if len(p) == length])
    return found


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put every row into one of ``shards`` shards so that the largest holds as few bytes as can be.

    ``docs``: ``doc_id`` and ``text``. A row's size is the UTF-8 length of its text plus 1 (a
    null text counts as empty, and as equal to an empty one). Rows of equal texts stay together.
    Returns for each row doc_id, size, text_crc32 (of the UTF-8 bytes), shard and slot: the
    row's place in its shard, from 0 without gaps, in the order of digest, doc_id and input.
    Repeated rows are rows of their own. Fewer groups than shards leave shards empty; an empty
    table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = cut_lineage(slim.groupBy("digest").agg(F.sum("size").alias("size")), "shard-groups")
    shard = F.lit(0)
    for start in cut_points(groups, shards):
        shard = shard + (F.col("digest") >= start).cast("int")
    order = ["digest", "doc_id", "row"]
    ordered = cut_lineage(
        slim.withColumn("shard", shard).repartitionByRange(*order).sortWithinPartitions(*order)
        .select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("at")),
        "shard-order")
    # one row for each task and each shard that it has rows of: tasks + shards rows at most
    part = F.shiftright("at", 33).alias("part")
    runs = ordered.groupBy(part, "shard").agg(F.min("at").alias("from"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return (ordered.withColumn("part", F.shiftright("at", 33))
            .join(F.broadcast(runs), ["part", "shard"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("base") + F.col("at") - F.col("from")).alias("slot")))
