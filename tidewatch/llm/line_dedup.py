"""Operator 7: line deduplication by content-defined line chunks.

A window rolls over the lines of a text; at each line that is not blank it is a chunk of ``least``
such lines (two), with the blank ones between them. A chunk depends on its own lines only, so
that surroundings, a line more or less, or the chunk before never hide a repeat: a run of two or
more lines is the union of its chunks, and goes as a whole if it is anywhere before. Digests find
repeated chunks; then their bytes are fetched and compared, as keys of a group-by. Chunks of a
digest that stands for different bytes (none is known) all stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, sliced
from tidewatch.llm.firsts import later, place
from tidewatch.llm.skew import attach
from tidewatch.llm.spans import cut_spans, numbered
from tidewatch.session import cut_lineage

#: Lines of a chunk that are not blank.
LEAST = 2
CHUNKS = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("d1", pa.int64()), ("d2", pa.int64()), ("own", pa.bool_())])
TEXTS = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("chunk", pa.binary())])


def line_chunks(text: bytes, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, end) of every chunk of ``least`` lines that are not blank, in order; they overlap.

    The newline after the last line of a chunk is part of it. Blank lines at the start and end of
    a text make one more chunk each, together with the first or last one, so that copies go whole.
    """
    starts, ends, at = [], [], 0
    for line in text.splitlines(keepends=True) if b"\r" not in text else _lines(text):
        if not line.isspace():
            starts.append(at)
            ends.append(at + len(line))
        at += len(line)
    out = list(zip(starts, ends[least - 1:]))
    if out and starts[0] > 0:
        out.insert(0, (0, out[0][1]))
    if out and ends[-1] < at:
        out.append((out[-1][0], at))
    return out


def _lines(text: bytes) -> list[bytes]:
    parts = text.split(b"\n")
    return [p + b"\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


def _bare(text: bytes, start: int, end: int) -> bytes:
    """A chunk without its last newline: at the end of a text there is none."""
    return text[start:end].removesuffix(b"\n")


def chunks(rows: DataFrame, least: int) -> DataFrame:
    """All chunks: row, doc, start, length, the halves of the digest, and own: whether the same text
    has the chunk before."""
    def cut(batches):
        for batch in sliced(batches, "text"):
            start, length, digests, own, counts = [], [], [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                seen, before = set(), len(start)
                for a, b in line_chunks(text, least):
                    start.append(a)
                    length.append(b - a)
                    digests.append(hashlib.blake2b(_bare(text, a, b), digest_size=16).digest())
                    own.append(digests[-1] in seen)
                    seen.add(digests[-1])
                counts.append(len(start) - before)
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            row, doc = (np.repeat(batch.column(c).to_numpy(), counts) for c in (0, 1))
            yield batch_of(CHUNKS, row, doc, start, length, d[:, 0], d[:, 1], own)

    return rows.select("row", place(), "text").mapInArrow(
        cut, "row long, doc long, start long, length long, d1 long, d2 long, own boolean")


def chunk_texts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """d1, d2 and the bytes of each chunk of ``found``."""
    spans = found.groupBy("row").agg(F.collect_list(F.struct("start", "length", "d1", "d2")).alias("spans"))

    def take(batches):
        for batch in sliced(batches, "text"):
            d1, d2, out = [], [], []
            for text, spans_ in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                for x in spans_:
                    d1.append(x["d1"])
                    d2.append(x["d2"])
                    out.append(_bare(text, x["start"], x["start"] + x["length"]))
            yield batch_of(TEXTS, d1, d2, out)

    return (rows.join(spans, "row").select("text", "spans")
            .mapInArrow(take, "d1 long, d2 long, chunk binary"))


def line_dedup(docs: DataFrame, least: int = LEAST, changed: bool = False) -> DataFrame:
    """Texts without the multi-line chunks that the table has before.

    ``docs``: doc_id and text; lines end at "\\n". Returns for each row: row (its number in the
    table), doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes). A line goes if it
    is in a run of ``least`` or more lines that are not blank which the table has before (in its
    order; the two may overlap), so the first occurrence of a line always stays, and so do a
    line alone, a text of one line, and a null or empty one. Blank lines go inside of a run, or
    at the text's ends. Repeated rows are copies of each other. An empty table gives no rows.
    With ``changed``, only rows that lose something are returned.
    """
    rows = numbered(docs)
    keys = ["d1", "d2"]
    found = cut_lineage(chunks(rows, least), "line-chunks")
    twice = cut_lineage(found.groupBy(*keys).agg(F.count("*").alias("n"), F.min("doc").alias("first"))
                        .filter("n > 1"), "line-digests")
    again = cut_lineage(attach(found, twice, keys), "line-repeats")
    # byte comparison: equal texts meet in one group, and partial counts make it small first
    texts = chunk_texts(rows, again).groupBy(*keys, "chunk").agg(F.count("*").alias("m"))
    unequal = texts.groupBy(*keys).agg(F.count("*").alias("texts")).filter("texts > 1").select(*keys)
    unequal = cut_lineage(unequal, "line-unequal")
    spans = later(rows, again, keys).join(unequal, keys, "left_anti")
    return cut_spans(rows, spans.select("row", "start", "length"), only=changed)
