"""The event-time buffer of the stateful operators: sorted runs of blocks in the state store.

``packed`` turns a stream into one row for each series of an Arrow batch, which holds its rows sorted;
these meet by series in ``transformWithStateInPandas``, whose state lies on the executors' disks (RocksDB).
``Waiting`` keeps a series' rows there as runs of about ``RUN_BYTES``, in blocks of ``BLOCK_BYTES``, and
releases them by merging runs block by block. So a Python worker holds a run or a block of each run, however
many rows wait; runs are merged when there are more than ``RUNS``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

#: Event time as microseconds, beside the rows in the buffer.
AT = "_at"
EVENT, SERIES, ROWS = "event_at", "series", "block"
RUN_BYTES, BLOCK_BYTES, RUNS = 16 << 20, 256 << 10, 16
#: Of a run in the merge: its place among the runs, and whether its block ends here with more to come.
OF, ENDS = "_of", "_ends"
RUN_STATE = "first array<bigint>, stop array<bigint>, size array<bigint>, head array<bigint>, timer bigint"


def buffer_schema(stream: DataFrame, columns: Sequence[str]) -> pa.Schema:
    fields = {f.name: f for f in stream.schema.fields}
    kept = StructType([fields[c] for c in dict.fromkeys(columns)] + [StructField(AT, LongType())])
    return to_arrow_schema(kept)


def _blob(table: pa.Table) -> bytes:
    batches = table.combine_chunks().to_batches()
    return batches[0].serialize().to_pybytes()


def _table(blob: bytes, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(blob), schema)])


def packed(stream: DataFrame, schema: pa.Schema, series: Sequence[str], ts: str, delay: str) -> DataFrame:
    """The stream as (series, last event time, rows) with its watermark: rows of a series and Arrow batch.

    TIMESTAMP_NTZ is read under the session time zone, which ``build_session`` sets to UTC. A row without
    a time waits for nothing and is left out.
    """
    out = pa.schema([(SERIES, pa.string()), ("last", pa.int64()), (ROWS, pa.binary())])

    def pack(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch]).select(schema.names).cast(schema)
            rows = rows.filter(pc.is_valid(rows.column(AT)))
            if not rows.num_rows:
                continue
            numbers = [rows.column(c).combine_chunks().dictionary_encode("encode").indices for c in series]
            by = [f"_{k}" for k in range(len(numbers))]
            order = pc.sort_indices(pa.table([*numbers, rows.column(AT)], names=[*by, AT]),
                                    sort_keys=[(c, "ascending") for c in [*by, AT]])
            rows = rows.take(order)
            ends = np.zeros(rows.num_rows, bool)
            for n in numbers:
                n = n.take(order).to_numpy(zero_copy_only=False)
                ends[:-1] |= n[1:] != n[:-1]
            stops = [*(np.flatnonzero(ends) + 1).tolist(), rows.num_rows]
            parts = [rows.slice(a, b - a) for a, b in zip([0, *stops], stops)]
            yield pa.RecordBatch.from_arrays([
                pa.array([repr([p.column(c)[0].as_py() for c in series]) for p in parts], pa.string()),
                pa.array([p.column(AT)[-1].as_py() for p in parts], pa.int64()),
                pa.array([_blob(p) for p in parts], pa.binary())], schema=out)

    timed = stream.withColumn(AT, F.unix_micros(F.col(ts).cast("timestamp"))).select(*(f"`{c}`" for c in schema.names))
    blocks = timed.mapInArrow(pack, f"{SERIES} string, last long, {ROWS} binary")
    return blocks.select(SERIES, F.timestamp_micros("last").alias(EVENT), ROWS).withWatermark(EVENT, delay)


class Waiting:
    """Rows of the series at hand that the watermark has not reached. Made in ``init`` of a processor."""

    def __init__(self, handle, schema: pa.Schema, order: Sequence[str]):
        self.handle, self.schema = handle, schema
        self.order = [(c, "ascending") for c in (AT, *order, OF)]
        self.blocks = handle.getMapState("waiting", "id long", "rows binary")
        self.index = handle.getValueState("runs", RUN_STATE)

    def taken(self, frames: Iterable, mark: int, fired: bool = False) -> Iterator[pa.Table]:
        """Adds the rows of ``frames`` that are not late; gives those that ``mark`` (the watermark in
        milliseconds) has reached, in order, and sets the timer of the earliest one that stays."""
        first, stop, size, head, timer = self.index.get() if self.index.exists() else ([], [], [], [], None)
        #: first block, the one behind the last, rows, first time in milliseconds
        runs = [list(r) for r in zip(first, stop, size, head)]
        self.next = max(stop, default=0)
        self._add(runs, frames, mark)
        yield from self._merge(runs, mark)
        runs = [r for r in runs if r[2]]
        due = max(min(r[3] for r in runs), mark + 1) if runs else None    # it fires when the watermark has passed it
        if due != timer or fired:
            if timer is not None and not fired:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.index.update((*([r[k] for r in runs] for k in range(4)), due))

    def _add(self, runs: list, frames: Iterable, mark: int) -> None:
        new, held = [], 0

        def run():
            rows = pa.concat_tables(new)
            runs.append(self._written([rows.take(pc.sort_indices(rows, sort_keys=self.order[:-1]))]))
            if len(runs) > RUNS:             # neighbours, so that equal rows stay in the order of their arrival
                n = RUNS // 2
                at = min(range(len(runs) - n + 1), key=lambda k: sum(r[2] for r in runs[k:k + n]))
                runs[at:at + n] = [self._written(self._merge(runs[at:at + n]))]

        for frame in frames:
            for blob in frame[ROWS]:
                rows = _table(blob, self.schema)
                rows = rows.filter(pa.array(rows.column(AT).to_numpy() // 1000 > mark))      # the others are late
                if rows.num_rows:
                    new.append(rows)
                    held += rows.nbytes
                if held >= RUN_BYTES:
                    run()
                    new, held = [], 0
        if new:
            run()

    def _written(self, tables: Iterable[pa.Table]) -> list:
        """Sorted rows as a run of blocks: its entry in the index."""
        run, rest = [self.next, self.next, 0, None], []

        def write(last: bool):
            rows = pa.concat_tables(rest).combine_chunks()
            step = max(1, rows.num_rows * BLOCK_BYTES // max(rows.nbytes, 1))
            at = 0
            while at < rows.num_rows and (last or rows.num_rows - at >= step):
                self.blocks.updateValue((self.next,), (_blob(rows.slice(at, step)),))
                self.next += 1
                at += step
            rest[:] = [rows.slice(at)] if at < rows.num_rows else []

        for table in tables:
            if run[3] is None:
                run[3] = table.column(AT)[0].as_py() // 1000
            run[2] += table.num_rows
            rest.append(table)
            if sum(t.nbytes for t in rest) >= BLOCK_BYTES:
                write(False)
        if rest:
            write(True)
        run[1] = self.next
        return run

    def _merge(self, runs: list, mark: int | None = None) -> Iterator[pa.Table]:
        """Rows of the runs in order, up to ``mark``; what was given leaves the state and the runs' entries."""
        loaded = self.schema.append(pa.field(OF, pa.int64())).append(pa.field(ENDS, pa.bool_())).empty_table()
        open_ = [k for k, r in enumerate(runs) if mark is None or r[3] <= mark]
        starved = open_
        while True:
            for k in starved:
                run = runs[k]
                rows = _table(self.blocks.getValue((run[0],))[0], self.schema)
                self.blocks.removeKey((run[0],))
                run[0] += 1
                ends = np.zeros(rows.num_rows, bool)
                ends[-1] = run[0] < run[1]
                loaded = pa.concat_tables([loaded, rows.append_column(OF, pa.array(np.full(rows.num_rows, k)))
                                           .append_column(ENDS, pa.array(ends))])
            if not loaded.num_rows:
                return
            loaded = loaded.take(pc.sort_indices(loaded, sort_keys=self.order))
            # behind the first end of a block there may be rows before these in the block that follows
            ends = np.flatnonzero(loaded.column(ENDS).to_numpy())
            sure = int(ends[0]) + 1 if len(ends) else loaded.num_rows
            at = loaded.column(AT).to_numpy()
            reached = sure if mark is None else int(np.searchsorted(at[:sure] // 1000, mark, "right"))
            starved = [loaded.column(OF)[sure - 1].as_py()] if len(ends) and reached == sure else []
            if reached:
                given = loaded.slice(0, reached)
                for k, n in zip(*np.unique(given.column(OF).to_numpy(), return_counts=True)):
                    runs[k][2] -= int(n)
                loaded = loaded.slice(reached)
                yield given.drop_columns([OF, ENDS])
            if not starved:
                break
        of = loaded.column(OF).to_numpy()
        for k in np.unique(of).tolist():             # what the mark has not reached goes back in its block's place
            rows = loaded.filter(pa.array(of == k)).drop_columns([OF, ENDS])
            runs[k][0] -= 1
            runs[k][3] = rows.column(AT)[0].as_py() // 1000
            self.blocks.updateValue((runs[k][0],), (_blob(rows),))
