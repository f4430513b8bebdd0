"""Option objects (driver side). Defaults follow the monitored job's code defaults."""

from __future__ import annotations

from dataclasses import dataclass

MODES = ("zscore", "seasonal", "classical")


@dataclass(frozen=True)
class DetectOptions:
    window_size: int = 30
    z_threshold: float = 3.0
    min_periods: int | None = None          # None -> window_size
    mode: str = "zscore"                    # zscore | seasonal (STL) | classical
    seasonal_period: int = 7
    min_cycles: int = 2
    # rows per chunk for the halo plan of very long series (None = one window
    # partition per series)
    chunk_rows: int | None = None
    # automatic split: series longer than this many rows use halo chunks of this size,
    # the rest one window partition each (costs one partially aggregated size pass)
    hot_series_rows: int | None = None
    # score only rows at/after this timestamp (plain z-score): each series keeps its last
    # window_size - 1 earlier rows as lookback, so results equal a full rescore
    score_from: str | None = None

    def validated(self) -> "DetectOptions":
        if self.window_size < 2:
            raise ValueError("A rolling window has two rows or more: check window_size.")
        if self.z_threshold <= 0:
            raise ValueError("Anomalies need a threshold above zero: check z_threshold.")
        if self.mode not in MODES:
            raise ValueError(f"{self.mode!r} is none of the modes {', '.join(MODES)}.")
        if self.min_periods is not None and self.min_periods < 1:
            raise ValueError("min_periods must be >= 1.")
        if self.seasonal_period < 2:
            raise ValueError("seasonal_period must be >= 2.")
        if self.chunk_rows is not None and self.chunk_rows < self.window_size - 1:
            raise ValueError("chunk_rows must be >= window_size - 1.")
        if self.hot_series_rows is not None and self.hot_series_rows < self.window_size - 1:
            raise ValueError("hot_series_rows must be >= window_size - 1.")
        if self.mode != "zscore" and self.score_from is not None:
            raise ValueError("score_from needs mode zscore: a decomposition takes the whole series.")
        return self

    @property
    def periods(self) -> int:
        return self.window_size if self.min_periods is None else self.min_periods


@dataclass(frozen=True)
class SuppressOptions:
    enabled: bool = True
    escalation_z_delta: float = 2.0
    # 'run': a metric resets only when the whole run has no anomaly for it (code
    # behaviour); 'point': every in-range observation resets it (documented behaviour)
    reset_scope: str = "run"

    def validated(self) -> "SuppressOptions":
        if not self.escalation_z_delta >= 0:
            raise ValueError("An escalation can't need less than the last alert: escalation_z_delta is below 0.")
        return self


@dataclass(frozen=True)
class CoOccurrenceOptions:
    window_days: int = 0
    # 'window': others within +/- window_days of each anomaly date, per (metric, date)
    # 'strict': one list per metric, same calendar date, last date wins
    mode: str = "window"
