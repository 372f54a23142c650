"""Statistics per sliding event-time window and indicator, on tables and on streams."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.stats import finished, merged_columns, partial_columns
from tidegauge.settings import LATENESS, WINDOW_SLIDE, WINDOW_WIDTH

UNITS = ("weeks", "days", "hours", "minutes", "seconds", "milliseconds", "microseconds")


def span(interval: str) -> timedelta:
    """Length of an interval such as "30 seconds" or "1 hour 30 minutes"."""
    parts = re.findall(r"(\d+)\s*([a-z]+)", interval.lower())
    lengths = {unit.rstrip("s") + "s": int(number) for number, unit in parts}
    if not lengths or not set(lengths) <= set(UNITS) or len(lengths) < len(parts):
        raise ValueError(f"not an interval of fixed length: {interval!r}")
    return timedelta(**lengths)


def pane_of(width: str, slide: str) -> str:
    """The longest interval that divides both."""
    micro = timedelta(microseconds=1)
    return f"{math.gcd(span(width) // micro, span(slide) // micro)} microseconds"


def finish_windows(df: DataFrame) -> DataFrame:
    """Window struct to the columns `start` and `end`, result columns in their fixed order."""
    return df.select("window.start", "window.end", "indicator", "avg_value", "max_value", "cnt")


def window_stats(
    df: DataFrame,
    width: str = WINDOW_WIDTH,
    slide: str = WINDOW_SLIDE,
    lateness: str = LATENESS,
    time: str = "event_time",
    panes: bool = True,
) -> DataFrame:
    """Mean, maximum and count per window `[start, end)` and indicator.

    Windows are aligned to the epoch. A stream gets a watermark `lateness` behind the latest event
    time; on a table every row counts.

    Overlapping windows of a table are built from panes, unless `panes` is off, which saves a small
    shuffle where most windows hold a single row. A stream takes one stateful step: whether a row is
    late is asked per (row, window), and a pane closed on its own would be lost to both its windows.
    """
    if df.isStreaming:
        return _one_step(df.withWatermark(time, lateness), width, slide, time)
    if panes and span(slide) < span(width):
        return _two_steps(df, width, slide, time)
    return _one_step(df, width, slide, time)


def _one_step(df: DataFrame, width: str, slide: str, time: str) -> DataFrame:
    """Each row is copied into every window it belongs to. The state of a stream holds the partial
    results, in their order (`streaming.state` reads them)."""
    window = F.window(time, width, slide).alias("window")
    partials = df.groupBy(window, "indicator").agg(*partial_columns())
    return finish_windows(partials.select("window", "indicator", *finished()))


def pane_partials(df: DataFrame, pane: str, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Partial results per pane, indicator and `keys`: all that windows made of panes ask of their rows."""
    begin = F.window(time, pane)["start"].alias("pane")
    return df.select(*keys, begin, "indicator", "value").groupBy(*keys, "pane", "indicator").agg(*partial_columns())


def windows_of_panes(panes: DataFrame, width: str, slide: str) -> DataFrame:
    """Window results from `pane_partials`; a pane may come in several parts."""
    window = F.window("pane", width, slide).alias("window")
    return finish_windows(panes.groupBy(window, "indicator").agg(*merged_columns()))


def _two_steps(df: DataFrame, width: str, slide: str, time: str) -> DataFrame:
    """Two steps: rows to panes, panes to windows.

    Copying each row into width/slide windows multiplies the rows before the costly aggregation.
    A pane is the longest stretch no window edge cuts, so each row is read, hashed and shuffled as
    part of one pane, and only finished panes, whose number does not grow with the rows, are copied.
    Both steps combine on the map side, so a hot indicator or window reaches a reducer as at most
    one record per map task.
    """
    return windows_of_panes(pane_partials(df, pane_of(width, slide), time), width, slide)
