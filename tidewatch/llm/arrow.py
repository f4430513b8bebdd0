"""Arrow helpers for code that runs inside tasks.

Spark hands a task record batches of up to ``maxRecordsPerBatch`` rows. Numpy work takes
several times the size of its input, so the helpers cut batches into slices of bounded bytes
before anything is computed (a single text longer than the bound makes a slice of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_KEPT: dict = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()``, kept by the worker process until another key is asked for.

    A worker serves the stages of a job one after another; what one stage has looked up is of no
    use to the next, and would stay in memory beside it.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Give back what Arrow holds for batches to come; a worker that waits holds on to it."""
    pa.default_memory_pool().release_unused()


def utf8(col: pa.Array) -> pa.Array:
    """A string column without nulls (null counts as empty), with 32-bit offsets."""
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    return col.fill_null("") if col.null_count else col


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and n + 1 offsets into them."""
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int32, len(col) + 1, col.offset * 4).astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), off - off[0]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    return raw, off - off[0]


def sliced(batches: Iterable[pa.RecordBatch], column: str,
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds at most ``max_bytes`` in each, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        k = batch.schema.get_field_index(column)
        arrays = list(batch.columns)
        arrays[k] = utf8(arrays[k]) if not pa.types.is_binary(arrays[k].type) else arrays[k]
        batch = pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)
        off = np.frombuffer(arrays[k].buffers()[1], np.int32, n + 1, arrays[k].offset * 4)
        at = 0
        while at < n:
            to = int(np.searchsorted(off, int(off[at]) + max_bytes, "right")) - 1
            to = min(n, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to
    batch = arrays = off = None
    release()


def whole_groups(batches: Iterable[pa.RecordBatch], key: str,
                 min_rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that arrive sorted by ``key`` (an integer column).

    Rows of the last group are held back until the next batch shows that it has ended.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < min_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys != keys[-1], False)) if keys[0] != keys[-1] else 0
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if cut or keys[0] != keys[-1] else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    held = table = None
    release()


def starts_of(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], change, [len(keys)]]).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), end to end."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)
