"""Event time, watermarks and time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.keyed import in_one


def with_event_time(df: DataFrame, time: Column, delay: str | None, name: str = "ts") -> DataFrame:
    """Set the event time and how late rows may come.

    ``delay`` is an interval such as ``'1 second'``; ``'0 seconds'`` says times only go up,
    None sets no watermark. On a bounded frame the watermark has no effect. Epoch millis go
    in as ``F.timestamp_millis(c)``; a stream refuses ``timestamp_ntz``, cast it first.
    """
    df = df.withColumn(name, time)
    return df if delay is None else df.withWatermark(name, delay)


def tumbling(
    df: DataFrame,
    size: str,
    aggs: Sequence[Column],
    keys: Sequence[str] = (),
    time: str = "ts",
    slide: str | None = None,
) -> DataFrame:
    """``aggs`` per window of ``size`` (aligned to the epoch), over all rows or per key.

    Give aggregates that combine before the shuffle (sum, count, avg, max_by): a window over
    the whole stream is a single group. With ``slide`` windows overlap.
    """
    start, end = F.col("win.start").alias("window_start"), F.col("win.end").alias("window_end")
    if df.isStreaming or slide:  # on a stream only the window tells a watermark when its state may go
        window = F.window(time, size, slide) if slide else F.window(time, size)
        grouped = df.groupBy(window.alias("win"), *keys).agg(*aggs)
        return grouped.select(start, end, *[c for c in grouped.columns if c != "win"])
    # One time as the key is far cheaper to sort and compare than a struct of two. The end is
    # that of the window which the start is in.
    grouped = df.withColumn("win", F.window(time, size)).groupBy(start, *keys).agg(*aggs)
    with_end = grouped.withColumn("win", F.window("window_start", size))
    return with_end.select("window_start", end, *[c for c in grouped.columns if c != "window_start"])


def tumbling_last(
    df: DataFrame, size: str, value: str, order: Sequence[str], time: str = "ts", keys: Sequence[str] = ()
) -> DataFrame:
    """The last ``value`` by ``order`` and the number of rows in each window. With a number or
    time as ``value`` and a time and a whole number as ``order`` nothing is sorted."""
    last = F.max_by(F.col(value), in_one(df, order)).alias("last")
    return tumbling(df, size, [last, F.count("*").alias("n")], keys, time)
