"""Windows that end with the data, on a stream: state per key instead of a sort."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewheel.streaming.packing import BODY, KEY, in_order, pack, unpack

_PIECE = 10_000  # rows taken from or put into the state, or emitted, at a time
_BUFFER = T.StructType([T.StructField(BODY, T.StringType())])
# rows in the buffer, time of its first row, number of the window being filled
_COUNTERS = T.StructType([T.StructField(n, T.LongType()) for n in ("rows", "first", "window_no")])


def _pieces(rows: Iterator, size: int = _PIECE) -> Iterator[list]:
    piece = []
    for row in rows:
        piece.append(row)
        if len(piece) == size:
            yield piece
            piece = []
    if piece:
        yield piece


# (texts of rows, window, place in the window of the first of them)
Part = tuple[Sequence[str], int, int]


def _frames(key: tuple, parts: Iterator[Part]) -> Iterator[pd.DataFrame]:
    """Parts of windows as frames of about ``_PIECE`` rows: a frame for each window would cost
    more than all else."""

    def frame(some: list[Part]) -> pd.DataFrame:
        sizes = [len(bodies) for bodies, _, _ in some]
        places = [np.arange(place, place + n) for (_, _, place), n in zip(some, sizes)]
        windows = np.repeat([window_no for _, window_no, _ in some], sizes)
        bodies = np.concatenate([np.asarray(b, dtype=object) for b, _, _ in some])
        return pd.DataFrame({KEY: key[0], "window_no": windows, "place": np.concatenate(places), BODY: bodies})

    waiting, rows = [], 0
    for part in parts:
        waiting.append(part)
        rows += len(part[0])
        if rows >= _PIECE:
            yield frame(waiting)
            waiting, rows = [], 0
    if waiting:
        yield frame(waiting)


class _Until(StatefulProcessor):
    """Buffers a key's rows and emits them when the trigger, the cap or the time limit is met."""

    def __init__(self, order: list[str], max_events: int | None, millis: int | None):
        self.order, self.max_events, self.millis = order, max_events, millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", _BUFFER)
        self.counters = handle.getValueState("counters", _COUNTERS)

    def _open_window(self) -> tuple[int, int, int]:
        counters = self.counters.get()
        return tuple(map(int, counters)) if counters else (0, 0, 0)

    def _emit(self, buffered: int, bodies: Sequence[str], window_no: int) -> Iterator[Part]:
        """The buffer, which is cleared, and then ``bodies``."""
        if buffered:
            place = 0
            for piece in _pieces(self.buffer.get()):
                yield [row[0] for row in piece], window_no, place
                place += len(piece)
            self.buffer.clear()
        if len(bodies):
            yield bodies, window_no, buffered

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        yield from _frames(key, self._take_in(in_order(rows, self.order)))

    def _take_in(self, pdf: pd.DataFrame) -> Iterator[Part]:
        bodies, triggers = pdf[BODY].to_numpy(), np.flatnonzero(pdf["flag"].to_numpy())
        times = pdf["time"].to_numpy() if self.millis else None
        buffered, first, window_no = self._open_window()
        timer = first if buffered else None

        start, size = 0, len(pdf)
        while start < size:
            ends = []  # where the open window would end, for each rule that sees an end
            following = np.searchsorted(triggers, start)
            if following < len(triggers):
                ends.append(int(triggers[following]) + 1)
            if self.max_events and start + self.max_events - buffered <= size:
                ends.append(start + self.max_events - buffered)
            if self.millis:
                first = first if buffered else int(times[start])
                too_late = start + int(np.searchsorted(times[start:], first + self.millis))
                if too_late < size:
                    ends.append(too_late)
            end = min(ends, default=size)
            if ends:
                yield from self._emit(buffered, bodies[start:end], window_no)
                buffered, window_no = 0, window_no + 1
            else:
                for piece in _pieces((body,) for body in bodies[start:end]):
                    self.buffer.appendList(piece)
                buffered += end - start
            start = end

        self.counters.update((buffered, first, window_no))
        if self.millis:
            needed = first if buffered else None
            if timer is not None and timer != needed:
                self.handle.deleteTimer(timer + self.millis)
            if needed is not None and timer != needed:
                self.handle.registerTimer(needed + self.millis)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        buffered, first, window_no = self._open_window()
        if buffered and first + self.millis <= expiredTimerInfo.getExpiryTimeInMs():
            self.counters.update((0, 0, window_no + 1))
            yield from _frames(key, self._emit(buffered, (), window_no))

    def close(self) -> None:
        pass


def windows_until_stream(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: Column,
    fields: Sequence[str],
    max_events: int | None = None,
    seconds: float | None = None,
    time: str = "ts",
) -> DataFrame:
    """Rows of each window as it closes: keys, ``window_no``, ``place`` in it, ``fields``.

    A window ends with a row for which ``trigger`` holds, or at ``max_events`` rows, or
    ``seconds`` of event time, in whole milliseconds, after its first row (a stream with a
    watermark on ``time``, and ``order`` led by it). Rows of one window all come out in one micro-batch.

    ``order`` sorts the rows of a key within a micro-batch: event time, or ``partition`` and
    ``offset`` of a topic. They are sorted in memory, so bound micro-batches at the source.
    Open windows are in the state store on disk, and are read and emitted piece by piece; a key
    without one keeps three numbers there.
    Start it under ``stateful_settings``.
    """
    extra = {"flag": F.coalesce(trigger, F.lit(False))}
    if seconds:
        # the column under the watermark must go along for its timers to fire
        extra |= {"time": F.unix_millis(F.col(time)), "watermarked": F.col(time)}
    packed, by = pack(df, keys, order, fields, **extra)
    emitted = packed.groupBy(KEY).transformWithStateInPandas(
        _Until(by, max_events, int(seconds * 1000) if seconds else None),
        f"{KEY} string, window_no bigint, place bigint, {BODY} string",
        outputMode="Append",
        timeMode="EventTime" if seconds else "None",
    )
    return unpack(emitted, df, keys, ["window_no", "place"], fields)
