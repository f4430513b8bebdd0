"""Joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is hot; there are fewer than 1 / share of them.
HOT_SHARE = 1 / 1000


def attach(rows: DataFrame, table: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row for each key.

    ``table[n]`` is the number of rows of that key. Keys that hold more than a thousandth of
    all counted rows are joined where the rows are, by a broadcast of fewer than 1,000 rows
    (there can't be more of them, whatever the input); the others are shuffled, and none of
    them is large. Nothing is dropped. Both inputs are read twice: give written tables.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = table.filter(F.col(n) > total * HOT_SHARE)
    cold = table.filter(F.col(n) <= total * HOT_SHARE)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rest.join(cold.drop(n), keys).unionByName(rows.join(F.broadcast(hot.drop(n)), keys))
