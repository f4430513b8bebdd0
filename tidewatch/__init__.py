"""tidewatch: metric anomaly analytics on Spark (DataFrame/SQL first).

Main entry points::

    from tidewatch import (build_session, MetricSource, read_metrics, DetectOptions,
                           detect_anomalies, summarize, attach_notes, apply_suppression,
                           MonitorConfig, run_monitor)
"""

from .options import CoOccurrenceOptions, DetectOptions, SuppressOptions
from .session import build_session, cut_lineage, ensure_checkpoint_dir
from .sources.metrics import (MetricLoadError, MetricSource, WideMetrics, clean_wide,
                              read_metrics, to_long, to_wide)
from .sources.state import read_state, write_state
from .sources.state_log import StateConflict, commit_state, read_log
from .operators.cube import metric_cube, pivot_cube
from .operators.rolling import detect_anomalies, detect_long, rolling_stats
from .operators.seasonal import seasonal_anomalies
from .operators.annotate import summarize, summary_view
from .operators.cooccur import attach_notes, co_occurrences
from .operators.suppress import apply_suppression, kept_only
from .operators.digest import alert_body_lines, alert_subject, digest_items
from .operators.report import report_tables, write_report
from .plans.monitor import MonitorConfig, run_monitor

__all__ = [
    "CoOccurrenceOptions", "DetectOptions", "SuppressOptions", "build_session", "cut_lineage",
    "ensure_checkpoint_dir", "MetricLoadError", "MetricSource", "WideMetrics", "clean_wide",
    "read_metrics", "to_long", "to_wide", "read_state", "write_state", "read_log",
    "commit_state", "StateConflict", "metric_cube",
    "pivot_cube", "detect_anomalies", "detect_long", "rolling_stats", "seasonal_anomalies",
    "summarize", "summary_view", "attach_notes", "co_occurrences", "apply_suppression",
    "kept_only", "alert_body_lines", "alert_subject", "digest_items", "report_tables",
    "write_report", "MonitorConfig", "run_monitor",
]
