"""Operator 10: byte-level BPE encoding and decoding.

Texts are split into pre-tokens; those a worker has not met yet are encoded together by
length-bucketed padded numpy matrices (``bpe.py``) and kept in a bounded cache. Ids travel as
little-endian unsigned 32-bit integers in one binary value for each document. Both directions
are map-side: no shuffle, and a lost partition is computed again from the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm.arrow import kept, sliced
from tidewatch.llm.bpe import load_tiktoken
from tidewatch.llm.pretoken import splitter

CACHE_ENTRIES = 300_000
TEXT_BYTES = 1 << 20


class Encoder:
    """The pieces that a worker has encoded, as packed ids."""

    def __init__(self, path: str, entries: int):
        self.bpe, self.entries, self.known, self.split = load_tiktoken(path), entries, {}, splitter()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        seen = set()
        for pieces in split:
            seen.update(pieces)
        missing = [p for p in seen if p not in self.known]
        if len(self.known) + len(missing) > self.entries:
            self.known, missing = {}, list(seen)
        self.learn(missing)
        get = self.known.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def learn(self, pieces: list[str]) -> None:
        raw, tokens = [p.encode() for p in pieces], self.bpe.tokens
        whole = [tokens.get(b) for b in raw]
        self.known.update((p, i.to_bytes(4, "little")) for p, i in zip(pieces, whole) if i is not None)
        rest = [k for k, i in enumerate(whole) if i is None]
        ids, counts = self.bpe.encode([raw[k] for k in rest])
        packed, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        at = 0
        for k, end in zip(rest, ends):
            self.known[pieces[k]] = packed[at:end]
            at = end


def encode(docs: DataFrame, ranks: str, entries: int = CACHE_ENTRIES) -> DataFrame:
    """All columns of ``docs`` and ``ids``: the text's token ids, packed.

    ``docs`` needs ``text`` (a null one counts as empty); a column ``ids`` that it has already
    is replaced. ``ids`` is binary: unsigned 32-bit little-endian integers end to end, empty for
    an empty text. No special tokens: their strings are ordinary text. One row comes out for
    each row, repeated or not; ``ranks`` is the path of a rank file, the same on every machine.
    """
    docs = docs.drop("ids")
    k = [c.lower() for c in docs.columns].index("text")
    fields = docs.schema

    def run(batches):
        encoder = kept(("encoder", ranks, entries), lambda: Encoder(ranks, entries))
        for batch in batches:
            named = [*batch.schema.names, "ids"]
            # the text once more, without nulls: its own column stays as it is
            batch = pa.RecordBatch.from_arrays([*batch.columns, batch.column(k)], names=named)
            for part in sliced([batch], "ids", TEXT_BYTES):
                ids = encoder.encode(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary())], names=named)

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("ids", T.BinaryType())]))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``: the bytes that the packed ``ids`` stand for.

    A null ``ids`` counts as empty. An id outside the vocabulary raises an error, as a sign that
    the ids come from another one.
    """
    encoded = encoded.drop("decoded")
    k = encoded.columns.index("ids")
    fields = encoded.schema

    def run(batches):
        get = load_tiktoken(ranks).bytes_of.__getitem__
        for batch in sliced(batches, "ids", TEXT_BYTES):
            out = [b"".join(map(get, np.frombuffer(b or b"", "<u4").tolist()))
                   for b in batch.column(k).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*fields, T.StructField("decoded", T.BinaryType())]))
