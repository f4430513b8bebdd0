"""Stateful streaming operators on ``transformWithStateInPandas``, with an event-time buffer.

* ``stream_zscore``      trailing-row z-score per series. The state holds the last ``w - 1``
                         released values (NULLs included: they occupy frame rows).
* ``stream_suppression`` the suppress/escalate rules per series; the state is one row
                         (state, last alert z / time, last value). With ``reset_scope='point'``
                         an in-range observation resets the series to normal.

Rows arrive in any order. Each series holds them back until the stream's watermark (the latest
event time seen, less ``delay``) has reached them; then a timer releases them in the order of
event time, whether or not the series got new rows. So the result does not depend on how the
rows were cut into micro-batches. A row whose time (in milliseconds, as watermarks count) is not after
the watermark when it arrives is late and dropped: nothing already released ever changes. Rows of the
last ``delay`` before the latest event stay in the state until later rows move the watermark on.

The buffer (``waiting.py``) lies in the state store as sorted runs of blocks, and rows are released
block by block, so a Python worker's memory does not grow with the rows that wait or arrive. The state
store must be RocksDB: ``run_available_now`` sees to it, other starts set ``STATE_STORE`` (``sinks.py``)
on the session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from ..options import DetectOptions, SuppressOptions
from .waiting import AT, SERIES, Waiting, buffer_schema, packed

STATE_NORMAL = "normal"
STATE_ACTIVE = "active_anomaly"


class _Released(StatefulProcessor):
    """``work`` on the rows of each series that the watermark has reached, in order, with its own state."""

    def __init__(self, held: pa.Schema, order: Sequence[str], work: Callable, state: str):
        self.held, self.order, self.work, self.state_schema = held, order, work, state

    def init(self, handle) -> None:
        self.waiting = Waiting(handle, self.held, self.order)
        self.state = handle.getValueState("series", self.state_schema)

    def handleInputRows(self, key, rows, timerValues):
        return self.work(self.waiting.taken(rows, timerValues.getCurrentWatermarkInMs()), self.state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self.work(self.waiting.taken([], timerValues.getCurrentWatermarkInMs(), fired=True), self.state)


def _by_series(stream: DataFrame, held: pa.Schema, series: Sequence[str], ts: str, delay: str,
               order: Sequence[str], work: Callable, state: str, out: StructType) -> DataFrame:
    return packed(stream, held, series, ts, delay).groupBy(SERIES).transformWithStateInPandas(
        _Released(held, order, work, state), out, "append", "EventTime")


def rolling_scores(buffer: np.ndarray, values: np.ndarray, window: int, min_periods: int):
    """n, mean, population std and z of ``values`` given the previous values ``buffer``."""
    pad = max(0, window - 1 - len(buffer))
    full = np.concatenate([np.full(pad, np.nan), buffer[-(window - 1):] if window > 1 else
                           np.empty(0), values])
    frames = np.lib.stride_tricks.sliding_window_view(full, window)
    valid = ~np.isnan(frames)
    n = valid.sum(axis=1)
    ok = n >= min_periods
    with np.errstate(invalid="ignore", divide="ignore"):
        total = np.where(valid, frames, 0.0).sum(axis=1)
        mean = np.where(n > 0, total / np.maximum(n, 1), np.nan)
        dev = np.where(valid, frames - mean[:, None], 0.0)
        sd = np.sqrt((dev ** 2).sum(axis=1) / np.maximum(n, 1))
        mean = np.where(ok, mean, np.nan)
        sd = np.where(ok, sd, np.nan)
        z = np.where(ok & (sd != 0), (values - mean) / sd, np.nan)
    return n, mean, sd, z


#: Rows scored at once: their frames take this many times the window in memory.
SCORED_ROWS = 4096


def stream_zscore(stream: DataFrame, options: DetectOptions, keys: Sequence[str] = (),
                  ts: str = "ts", value: str = "value", carry: Sequence[str] = (),
                  delay: str = "0 seconds") -> DataFrame:
    """Score every incoming row once the watermark has reached it: ``(keys, metric, carry..., ts,
    value, n_obs, rolling_mean, rolling_std, z)``. Rows of one time come in the order of ``carry``.
    Output mode append."""
    opts = options.validated()
    w, mp = opts.window_size, opts.periods
    sk = [*keys, "metric"]
    in_fields = {f.name: f for f in stream.schema.fields}
    out_schema = StructType([in_fields[c] for c in [*sk, *carry, ts, value]] + [
        StructField("n_obs", LongType()), StructField("rolling_mean", DoubleType()),
        StructField("rolling_std", DoubleType()), StructField("z", DoubleType())])
    names = [f.name for f in out_schema.fields]
    held = buffer_schema(stream, [*sk, *carry, ts, value])

    def score(rows, state):
        buffer = np.frombuffer(state.get()[0]) if state.exists() else np.empty(0)
        for table in rows:
            for k in range(0, table.num_rows, SCORED_ROWS):
                part = table.slice(k, SCORED_ROWS)
                values = part.column(value).to_numpy().astype(float)
                n, mean, sd, z = rolling_scores(buffer, values, w, mp)
                buffer = np.concatenate([buffer, values])[-(w - 1):]
                out = part.drop_columns([AT]).to_pandas()
                out["n_obs"], out["rolling_mean"], out["rolling_std"], out["z"] = n, mean, sd, z
                yield out[names]
        state.update((buffer.tobytes(),))

    return _by_series(stream, held, sk, ts, delay, carry, score, "buffer binary", out_schema)


NEW, ESCALATION, SUPPRESSED, KEPT = "new", "escalation", "suppressed", "kept"


def decide_streak(az: np.ndarray, last: float | None, delta: float) -> tuple[np.ndarray, float]:
    """Decisions of anomalies without an in-range row between them, and the last alert's |z|.
    ``last``: the |z| of the alert that the streak continues, or None."""
    out = np.full(len(az), SUPPRESSED, dtype=object)
    at = 0
    if last is None:
        out[0], last, at = NEW, az[0], 1
    if delta == 0:
        before = np.maximum.accumulate(np.concatenate([[last], az[at:]]))[:-1]
        out[at:][az[at:] >= before] = ESCALATION
        return out, float(max(last, az[at:].max(initial=last)))
    while at < len(az):
        higher = az[at:] - last >= delta
        step = int(higher.argmax())
        if not higher[step]:
            break
        at += step
        out[at], last = ESCALATION, az[at]
        at += 1
    return out, float(last)


def stream_suppression(stream: DataFrame, options: SuppressOptions = SuppressOptions(),
                       keys: Sequence[str] = (), ts: str = "event_ts",
                       anomaly_flag: str | None = None, delay: str = "0 seconds",
                       tiebreak: Sequence[str] = ("actual", "z_score")) -> DataFrame:
    """Decide anomalies in the order of event time, once the watermark has reached them.

    ``stream`` rows: keys, metric, ``ts``, timestamp (date text), z_score, actual and, for
    ``reset_scope='point'``, a boolean ``anomaly_flag`` column (False = in-range point). In-range
    points come before anomalies of the same time; anomalies of one time in the order of
    ``tiebreak``. Output (append): keys, metric, ts, timestamp, z_score, decision, is_escalation.
    """
    sk = [*keys, "metric"]
    options.validated()
    delta = float(options.escalation_z_delta)
    point = options.reset_scope == "point"
    if point and anomaly_flag is None:
        raise ValueError("reset_scope='point' needs the anomaly_flag column")
    in_fields = {f.name: f for f in stream.schema.fields}
    out_schema = StructType([in_fields[c] for c in [*sk, ts, "timestamp", "z_score"]] + [
        StructField("decision", StringType()), StructField("is_escalation", BooleanType())])
    names = [f.name for f in out_schema.fields]
    flagged = [anomaly_flag] if point else []
    held = buffer_schema(stream, [*sk, ts, "timestamp", "z_score", "actual", *flagged, *tiebreak])

    def decide(released, state):
        st, lz, lat, lv = state.get() if state.exists() else (STATE_NORMAL, None, None, None)
        for rows in released:
            flags = rows.column(anomaly_flag).to_numpy().astype(bool) if point else np.ones(rows.num_rows, bool)
            found = rows.filter(pa.array(flags))
            if found.num_rows:
                az = np.abs(found.column("z_score").to_numpy().astype(float))
                decisions = np.full(len(az), KEPT, dtype=object)
                if options.enabled:
                    # streaks: anomalies between two in-range rows; the first may continue the state
                    streak = np.cumsum(~flags)[flags]
                    start = np.concatenate([[0], np.flatnonzero(np.diff(streak)) + 1, [len(az)]])
                    decisions[:] = NEW
                    goes_on = st == STATE_ACTIVE and streak[0] == 0
                    last = (abs(lz) if lz is not None else 0.0) if goes_on else None
                    alone = np.diff(start) == 1
                    for k in np.flatnonzero(~alone | (np.arange(len(alone)) == 0) & goes_on):
                        a, b = start[k], start[k + 1]
                        decisions[a:b], top = decide_streak(az[a:b], last if k == 0 else None, delta)
                    k = len(start) - 2
                    a = start[k]
                    alerts = np.flatnonzero(decisions[a:] != SUPPRESSED)
                    if len(alerts):
                        lz, lat = float(az[a + alerts[-1]]), found.column("timestamp")[int(a + alerts[-1])].as_py()
                    else:
                        lz = last
                else:
                    lz, lat = float(az[-1]), found.column("timestamp")[-1].as_py()
                st, lv = STATE_ACTIVE, float(found.column("actual")[-1].as_py())
                out = found.to_pandas()
                out["decision"], out["is_escalation"] = decisions, decisions == ESCALATION
                yield out[names]
            if len(flags) and not flags[-1] and st == STATE_ACTIVE:
                st, lz, lat = STATE_NORMAL, None, None
        state.update((st, lz, lat, lv))

    return _by_series(stream, held, sk, ts, delay, [*flagged, *tiebreak], decide,
                      "state string, last_alert_z double, last_alert_at string, last_value double", out_schema)
