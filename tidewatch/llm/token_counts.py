"""Operator 1: token counts by a map-side two-tier lookup.

The first tier is a table of frequent pre-tokens and their lengths in tokens, broadcast once:
every vocabulary entry that is a pre-token as a whole, which are the pre-tokens its makers
found frequent. Its size is bounded by the vocabulary, whatever the corpus. Pre-tokens that
miss it are encoded once per worker and kept in the worker's own bounded cache. Documents are
read once, nothing is shuffled, and a lost executor's partitions are simply computed again.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, sliced
from tidewatch.llm.bpe import load_json
from tidewatch.llm.pretoken import splitter

#: Pre-tokens that a worker's cache holds before it starts anew.
CACHE_ENTRIES = 400_000
TEXT_BYTES = 4 << 20
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_WORKER: dict = {}          # one table for each vocabulary, kept by the worker process


def frequent_lengths(path: str) -> tuple[bytes, bytes]:
    """The first tier in compact form: pre-tokens joined by NUL, and one byte for each length."""
    bpe, _ = load_json(path)
    split, found = splitter(), []
    for token in bpe.tokens:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue                               # part of a character
        if "\0" not in text and split(text) == [text]:
            found.append(text)
    _, lengths = bpe.encode([t.encode() for t in found])
    fit = lengths < 256
    keep = [t for t, ok in zip(found, fit) if ok]
    return "\0".join(keep).encode(), lengths[fit].astype(np.uint8).tobytes()


class Lengths:
    """Both tiers in one worker."""

    def __init__(self, path: str, packed: tuple[bytes, bytes], entries: int):
        self.bpe, special = load_json(path)
        self.parts = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        keys, lengths = packed
        self.frequent = dict(zip(keys.decode().split("\0"), lengths)) if lengths else {}
        self.table, self.entries, self.split = dict(self.frequent), entries, splitter()

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of the text around special strings, and the number of those."""
        if self.parts is None or not self.parts.search(text):
            return self.split(text), 0
        parts = self.parts.split(text)
        return [p for part in parts for p in self.split(part)], len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pieces(t) for t in texts]
        seen = set()
        for pieces, _ in split:
            seen.update(pieces)
        missing = [p for p in seen if p not in self.table]
        if len(self.table) - len(self.frequent) + len(missing) > self.entries:
            self.table = dict(self.frequent)
            missing = [p for p in seen if p not in self.table]
        if missing:
            _, lengths = self.bpe.encode([p.encode() for p in missing])
            self.table.update(zip(missing, lengths.tolist()))
        get = self.table.__getitem__
        return [sum(map(get, pieces)) + special for pieces, special in split]


def token_counts(docs: DataFrame, vocabulary: str, entries: int = CACHE_ENTRIES) -> DataFrame:
    """Token count of every text, as the tokenizers library counts without added tokens.

    ``docs``: ``doc_id`` (integer, null allowed) and ``text``; other columns are left aside.
    Returns a row for each input row: doc_id, n_bytes (UTF-8), n_tokens. A null text counts as
    empty: 0 bytes, 0 tokens. Special strings inside a text count as one token each, as is the
    library's default. Repeated rows are counted each; an empty table gives no rows.
    ``vocabulary``: path of a byte-level BPE file in the tokenizers format, the same on every
    machine. ``entries`` bounds the worker cache and changes no result.
    """
    packed = docs.sparkSession.sparkContext.broadcast(frequent_lengths(vocabulary))

    def count(batches):
        key = (vocabulary, entries)
        if key not in _WORKER:
            _WORKER[key] = Lengths(vocabulary, packed.value, entries)
        lengths = _WORKER[key]
        for batch in sliced(batches, "text", TEXT_BYTES):
            texts = batch.column(1).to_pylist()
            size = pa.compute.binary_length(batch.column(1))
            yield batch_of(SCHEMA, batch.column(0), size.cast(pa.int64()), lengths.count(texts))

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
