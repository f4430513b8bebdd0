import datetime as dt

import numpy as np
import pytest

from tidewatch.plans.config import monitor_from_config, run_from_config, source_from_config
from tidewatch.sources.metrics import MetricLoadError


def test_config_mapping(monkeypatch):
    monkeypatch.setenv("DB_URL", "jdbc:postgresql://h/db")
    src = source_from_config({"input_mode": "database",
                              "db": {"connection_string": "ENV:DB_URL", "query": "SELECT 1"}})
    assert (src.kind, src.url, src.query) == ("jdbc", "jdbc:postgresql://h/db", "SELECT 1")
    with pytest.raises(MetricLoadError):
        source_from_config({"input_mode": "excel_file", "data": {"file_path": "x.xlsx"}})
    with pytest.raises(MetricLoadError):
        source_from_config({"input_mode": "nope"})
    cfg = monitor_from_config({"detection": {"mode": "seasonal", "window_size": 20},
                               "suppression": {"enabled": True, "escalation_z_delta": 1.5},
                               "correlation_window_days": 2}, "r1", "2024-06-30 00:00:00")
    assert cfg.detect.mode == "seasonal" and cfg.detect.window_size == 20
    assert cfg.suppress.enabled and cfg.suppress.escalation_z_delta == 1.5
    assert cfg.co_occurrence.window_days == 2


def test_run_from_config_csv(spark, tmp_dir):
    rng = np.random.default_rng(2)
    path = f"{tmp_dir}/metrics.csv"
    with open(path, "w") as fh:
        fh.write("Date,Revenue,Error_Rate\n")
        for i in range(60):
            d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            rev = 500 + rng.normal(0, 5) + (200 if i == 45 else 0)
            fh.write(f"{d},{rev:.3f},{1.5 + rng.normal(0, 0.1):.4f}\n")
    cfg = {"input_mode": "file", "data": {"file_path": path, "timestamp_column": "Date"},
           "detection": {"mode": "zscore", "window_size": 30, "z_threshold": 3.0},
           "suppression": {"enabled": True, "state_db_path": f"{tmp_dir}/state"}}
    out = run_from_config(spark, cfg, "000000000001", "2024-06-30 00:00:00")
    kept = out["summaries"].filter("metric = 'Revenue'").collect()
    assert any(r.timestamp == "2024-02-15" for r in kept)


def test_yaml_config_file(tmp_dir):
    from tidewatch.plans.config import load_config
    path = f"{tmp_dir}/config.yaml"
    with open(path, "w") as fh:
        fh.write("input_mode: folder\ndata:\n  folder_path: /data/in\n  timestamp_column: Date\n"
                 "detection:\n  mode: seasonal\n  window_size: 30\n")
    cfg = load_config(path)
    src = source_from_config(cfg)
    assert (src.kind, src.path, src.timestamp_column) == ("folder", "/data/in", "Date")
