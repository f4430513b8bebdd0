"""Cutting byte spans out of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, flat, ranges, sliced

CUT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                 ("n_spans", pa.int64()), ("kept", pa.binary())])


def numbered(docs: DataFrame) -> DataFrame:
    """row, doc_id and text. ``row`` tells rows apart that repeat a doc_id; like anything that two
    passes over ``docs`` must agree on, it needs a deterministic input, such as a table."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def union_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans merged where they overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return starts[new], reach[np.concatenate([new[1:], [len(starts)]]) - 1]


def cut_spans(rows: DataFrame, spans: DataFrame, least: int = 1, bridge: bool = False,
              only: bool = False) -> DataFrame:
    """Remove byte spans from texts.

    ``rows``: as ``numbered`` gives them. ``spans``: row, start, length; they may overlap. Spans
    are merged first; merged ones of fewer than ``least`` bytes are left in. Spans of a row are
    gathered in one value, which that row's text bounds. With ``bridge``, UTF-8 characters that a
    cut would split go as a whole. With ``only``, rows without spans are left out.
    Returns for each row: row, doc_id, n_bytes, n_removed, n_spans (merged) and kept (bytes).
    """
    gathered = spans.groupBy("row").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    joined = rows.join(gathered, "row", "inner" if only else "left").select("row", "doc_id", "text", "spans")

    def cut(batches):
        for batch in sliced(batches, "text"):
            data, off = flat(batch.column(2))
            lists = batch.column(3)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            starts, lengths = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in lists.flatten().flatten())
            size = np.diff(off)
            removed, n_spans = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            keep = np.ones(len(data), bool)
            which = np.repeat(np.arange(len(size)), counts)
            if len(starts):
                begin = starts + off[which]
                # a gap of one between texts keeps their spans apart
                a, b = union_of(begin + which, begin + lengths + which)
                of = np.searchsorted(off[1:] + np.arange(len(size)), a, "right")
                of = np.minimum(of, len(size) - 1)
                a, b = a - of, b - of
                if bridge:
                    while (inside := (a > off[of]) & (data[np.minimum(a, len(data) - 1)] & 0xC0 == 0x80)).any():
                        a = a - inside
                    while (inside := (b < off[of + 1]) & (data[np.minimum(b, len(data) - 1)] & 0xC0 == 0x80)).any():
                        b = b + inside
                fit = b - a >= least
                a, b, of = a[fit], b[fit], of[fit]
                keep[ranges(a, b - a)] = False
                n_spans = np.bincount(of, minlength=len(size))
                removed = np.bincount(of, b - a, len(size)).astype(np.int64)
            left = data[keep]
            ends = np.concatenate([[0], np.cumsum(size - removed)])
            kept = pa.Array.from_buffers(pa.binary(), len(size), [
                None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(left)])
            yield batch_of(CUT, batch.column(0), batch.column(1), size, removed, n_spans, kept)

    return joined.mapInArrow(cut, "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
