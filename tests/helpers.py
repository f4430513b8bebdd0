"""Small pandas references written from the detection rules (not imported from anywhere)."""

import numpy as np
import pandas as pd


def pandas_rolling(values, window, min_periods=None):
    """Trailing row window, current row included, population std, z with std 0 -> NaN."""
    s = pd.Series(values, dtype=float)
    mp = window if min_periods is None else min_periods
    mean = s.rolling(window, min_periods=mp).mean()
    std = s.rolling(window, min_periods=mp).std(ddof=0)
    z = (s - mean) / std.replace(0, np.nan)
    return mean.to_numpy(), std.to_numpy(), z.to_numpy()


def series_frame(spark, values, metric="m", start="2024-01-01", keys=None):
    dates = pd.date_range(start, periods=len(values), freq="D")
    rows = [(metric, d.to_pydatetime(), None if v is None else float(v))
            for d, v in zip(dates, values)]
    return spark.createDataFrame(rows, "metric string, ts timestamp_ntz, value double")
