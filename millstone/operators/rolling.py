"""Rolling means per asset over an hourly series.

Input is the *hourly* Gold table (one row per asset-hour), so a partition
holds at most the number of hours of one asset — bounded by time, not by
message volume.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from millstone.functions.timefn import epoch_micros


def rolling_rows(value: str, key: str = "asset", order: str = "hour_utc", rows: int = 168) -> Column:
    """Mean over the last ``rows`` rows (the current row included)."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(rows - 1), 0)
    return F.avg(value).over(w)


def rolling_time(value: str, key: str = "asset", order: str = "hour_utc", hours: int = 168) -> Column:
    """Mean over the hours in ``(t - hours, t]`` — true time range, so gaps
    shrink the window instead of stretching it."""
    secs = (epoch_micros(order) / 1000000).cast("long")
    w = Window.partitionBy(key).orderBy(secs).rangeBetween(-(hours * 3600 - 1), 0)
    return F.avg(value).over(w)
