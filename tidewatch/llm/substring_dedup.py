"""Operator 6: substring deduplication by content-defined chunks.

A gear rolling hash over the last 32 bytes marks chunk ends where its top bits are zero, so
that ends depend on content alone and move along with it when something is inserted before.
Chunks are compared by a 128-bit digest. The first chunk of each digest (in the order of
doc_id; see ``firsts``) stays; the others go, where they make up a run that is long enough.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, flat, mix64, sliced
from tidewatch.llm.firsts import later, place
from tidewatch.llm.skew import attach
from tidewatch.llm.spans import cut_spans, numbered
from tidewatch.session import cut_lineage

#: Bytes of a chunk at least and at most, and the bits that must be zero at its end.
LEAST, MOST, BITS = 16, 192, 5
#: Runs of repeated chunks below this many bytes are left in.
RUN = 64
CHUNKS = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("length", pa.int32()),
                    ("d1", pa.int64()), ("d2", pa.int64()), ("own", pa.bool_())])
GEAR = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum of GEAR[byte k back] << k, in 32 bits."""
    h = GEAR[data]
    step = 1
    while step < 32:                 # windows of 2, 4, ... 32 bytes from two halves each
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def chunk_ends(marks: list[int], start: int, end: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of [start, end), of which ``marks`` are the possible ones."""
    ends, last = [], start
    for mark in [*marks, end]:
        while mark - last > most:
            last += most
            ends.append(last)
        if mark - last >= least:
            ends.append(mark)
            last = mark
    if last < end:
        ends.append(end)
    return ends


def chunks(rows: DataFrame) -> DataFrame:
    """All chunks of all texts: row, doc (as ``place`` gives it), start, length, the two halves of the
    digest, and own: whether the same text has the chunk before."""
    def cut(batches):
        for batch in sliced(batches, "text"):
            data, off = flat(batch.column(2))
            marked = np.flatnonzero(gear(data) >> np.uint32(32 - BITS) == 0) + 1
            bounds, offs = np.searchsorted(marked, off, "right"), off.tolist()
            # a window that reaches back into the text before gives no end
            first = np.searchsorted(marked, off + 32, "left")
            marked, text = marked.tolist(), data.tobytes()
            start, length, digests, own, counts = [], [], [], [], []
            for k in range(len(batch)):
                last, seen, before = offs[k], set(), len(start)
                for end in chunk_ends(marked[first[k]:bounds[k + 1]], last, offs[k + 1]):
                    start.append(last - offs[k])
                    length.append(end - last)
                    digests.append(hashlib.blake2b(text[last:end], digest_size=16).digest())
                    own.append(digests[-1] in seen)
                    seen.add(digests[-1])
                    last = end
                counts.append(len(start) - before)
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            row, doc = (np.repeat(batch.column(c).to_numpy(), counts) for c in (0, 1))
            yield batch_of(CHUNKS, row, doc, start, length, d[:, 0], d[:, 1], own)

    return rows.select("row", place(), "text").mapInArrow(
        cut, "row long, doc long, start int, length int, d1 long, d2 long, own boolean")


def substring_dedup(docs: DataFrame, run: int = RUN) -> DataFrame:
    """Texts without what the table has before, of ``run`` bytes or more in one piece.

    ``docs``: doc_id and text. Returns for each row doc_id, n_bytes, n_removed, n_spans and kept
    (the remaining bytes; whole characters). Of equal chunks the first stays, by the order of
    doc_id (and of the text's hash among rows of one doc_id); a copy of a whole text loses all of
    it. A null or empty text has no chunks; one shorter than ``run`` stays as it is; repeated rows are copies; an empty table gives no rows.
    """
    rows = numbered(docs)
    keys = ["d1", "d2"]
    found = cut_lineage(chunks(rows), "chunks")
    groups = cut_lineage(found.groupBy(*keys).agg(F.count("*").alias("n"), F.min("doc").alias("first"))
                         .filter("n > 1"), "repeated")
    spans = later(rows, attach(found, groups, keys), keys).select("row", "start", "length")
    return cut_spans(rows, spans, least=run, bridge=True).drop("row")
