"""Windows that end with the data: a key's rows gather until one of them meets a condition.

Window rows come out one by one, labelled ``(key, window_no)``, which holds for windows of any
length; :func:`gather_windows` makes one row with a list per window for sinks that want that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators.chains import chain_starts
from tidewheel.operators.running import SPLIT_ROWS, Fold, HotKeys, find_hot_keys, running_fold

_FLAG = "__trigger"
# Stands for no time: before all others, and further from them than any time limit.
_UNTIMED = -(1 << 62)


def _as_flag(trigger: Column) -> Column:
    return F.coalesce(trigger.cast("long"), F.lit(0))


def windows_until(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], trigger: Column, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Rows of the finished windows with ``window_no`` (from 0 per key).

    A row for which ``trigger`` is true is the last of its window. Rows after a key's last
    trigger wait for one that has not come, so they are not part of the result.
    """
    hot = find_hot_keys(df, keys, order, split_rows)
    folds = [
        Fold("window_no", _as_flag(trigger), inclusive=False),
        Fold("__windows", _as_flag(trigger), whole=True),
    ]
    labelled = running_fold(df, keys, order, folds, hot)
    return labelled.where(F.col("window_no") < F.col("__windows")).drop("__windows")


def gather_windows(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    by: Sequence[str] = ("window_no",),
) -> DataFrame:
    """One row per window: its number of rows ``n`` and its ``events`` in order.

    A list is one value in one row, so a window must fit in memory. Where windows may be
    long, work on the labelled rows or cap them (:func:`windows_until_capped`).
    """
    item = F.struct(*order, *[f for f in fields if f not in order])
    gathered = rows.groupBy(*keys, *by).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(item)).alias("events")
    )
    keep = F.transform("events", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return gathered.withColumn("events", keep)


def _capped(
    df: DataFrame, keys: list[str], order: Sequence[str], trigger: Column, max_events: int, hot: HotKeys | None
) -> DataFrame:
    """All rows with ``window_no``, ``chunk``, ``__at`` (place in the window, from 1) and ``__closed``."""
    flagged = df.withColumn(_FLAG, _as_flag(trigger))
    folds = [Fold("window_no", F.col(_FLAG), inclusive=False), Fold("__windows", F.col(_FLAG), whole=True)]
    labelled = running_fold(flagged, keys, order, folds, hot)

    # plain windows by (key, window) need no further shuffle: rows are already together by key
    one = F.lit(1).cast("long")
    places = [Fold("__at", one), Fold("__rows", one, whole=True)]
    counted = running_fold(labelled, [*keys, "window_no"], order, places, hot)
    chunk = F.expr(f"(__at - 1) div {int(max_events)}")
    full = (F.col("chunk") + 1) * max_events <= F.col("__rows")
    closed = (F.col("window_no") < F.col("__windows")) | full
    return counted.withColumn("chunk", chunk).withColumn("__closed", closed).drop("__rows", "__windows", _FLAG)


def windows_until_capped(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: Column,
    max_events: int,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """:func:`windows_until` where a window also ends at ``max_events`` rows.

    Adds ``window_no`` (triggers before the row) and ``chunk`` (the window's place among the
    ones that the cap cut). Only rows of closed windows come out; the rest still waits.
    """
    hot = find_hot_keys(df, keys, order, split_rows)
    return _capped(df, list(keys), order, trigger, max_events, hot).where("__closed").drop("__at", "__closed")


def numbered_until(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: Column,
    max_events: int | None = None,
    seconds: float | None = None,
    now: int | None = None,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """All rows with their window's number (``window_no``, from 0 per key, whatever ended the window
    before) and ``__open``: whether the window still waits for more rows.

    A window ends with a trigger, at ``max_events`` rows, or ``seconds`` after its first row, of
    which one or the other may be given. Time has run out where a later row says so or ``now``, in
    milliseconds, has reached the limit.
    """
    if max_events and seconds:
        raise ValueError("a window ends at a number of rows or after a time, not both")
    keys, order = list(keys), list(order)
    hot = find_hot_keys(df, keys, order, split_rows)
    if max_events:
        counted = _capped(df, keys, order, trigger, max_events, hot)
        first = F.expr(f"(__at - 1) % {int(max_events)} = 0").cast("long")
        counted = running_fold(counted.drop("window_no"), keys, order, [Fold("__n", first)], hot)
        return counted.select(*df.columns, (F.col("__n") - 1).alias("window_no"), (~F.col("__closed")).alias("__open"))
    flag = _as_flag(trigger)
    if not seconds:
        folds = [Fold("window_no", flag, inclusive=False), Fold("__windows", flag, whole=True)]
        labelled = running_fold(df, keys, order, folds, hot)
        return labelled.select(*df.columns, "window_no", (F.col("window_no") == F.col("__windows")).alias("__open"))
    labelled = _timed(df, keys, order, trigger, seconds, hot, split_rows)
    labelled = running_fold(labelled, keys, order, [Fold("__last", F.col("window_no"), "max", whole=True)], hot)
    start = -F.unix_millis(order[0])
    folds = [Fold("__done", flag, "max", whole=True), Fold("__start", start, "max", whole=True)]
    labelled = running_fold(labelled, [*keys, "window_no"], order, folds, hot)
    over = F.lit(False) if now is None else F.coalesce(-F.col("__start") + int(seconds * 1000) <= now, F.lit(False))
    waits = (F.col("window_no") == F.col("__last")) & (F.col("__done") == 0) & ~over
    return labelled.select(*df.columns, "window_no", waits.alias("__open"))


def windows_until_timeout(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie_break: Sequence[str],
    trigger: Column,
    seconds: float,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """:func:`windows_until` where a window also ends ``seconds`` after its first row.

    A window takes the rows with time in ``[first, first + seconds)`` up to a trigger, by time
    in whole milliseconds. The input being complete, the last window of a key ends by its time
    too, so all rows come out. Adds ``window_no`` (from 0 per key). Rows without a time come
    first; they make windows of their own, ended by a trigger or the first row with a time.

    Where a window starts depends on where the one before did. That chain is followed over the
    distinct milliseconds only, per (key, stretch between triggers); one of more than
    ``split_rows`` of them is cut into slices (:mod:`tidewheel.operators.chains`). The rows
    themselves never leave the JVM: the starts come back as markers in front of the first row
    of their window, and a running count numbers the windows.
    """
    keys, order = list(keys), [time, *tie_break]
    if not isinstance(df.schema[time].dataType, T.TimestampType):
        raise TypeError(f"{time} must be a timestamp")
    return _timed(df, keys, order, trigger, seconds, find_hot_keys(df, keys, order, split_rows), split_rows)


def _timed(
    df: DataFrame, keys: list[str], order: list[str], trigger: Column, seconds: float, hot: HotKeys | None, split_rows: int
) -> DataFrame:
    labelled = running_fold(df, keys, order, [Fold("__stretch", _as_flag(trigger), inclusive=False)], hot)

    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    group = [*names.values(), "__stretch"]
    times = (
        labelled.select(*[F.col(k).alias(n) for k, n in names.items()], "__stretch", *order)
        .groupBy(*group, F.coalesce(F.unix_millis(order[0]), F.lit(_UNTIMED)).alias("__ms"))
        .agg(F.min(F.struct(*order)).alias("__first"))
    )
    # no more distinct times than rows: without a hot key no chain is long
    starts = chain_starts(times, group, "__ms", int(seconds * 1000), split_rows if hot else None)

    markers = starts.select(*[F.col(n).alias(k) for k, n in names.items()], "__first.*", F.lit(0).alias("__row"))
    marked = df.withColumn("__row", F.lit(1)).unionByName(markers, allowMissingColumns=True)
    windows = Fold("__windows", (F.lit(1) - F.col("__row")).cast("long"))
    numbered = running_fold(marked, keys, [*order, "__row"], [windows], hot)
    return numbered.where(F.col("__row") == 1).select(*df.columns, (F.col("__windows") - 1).alias("window_no"))
