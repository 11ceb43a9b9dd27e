"""The latest row of each key on a stream, in a state that forgets quiet keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewheel.streaming.packing import BODY, KEY, in_order, pack, unpack


class _Latest(StatefulProcessor):
    def __init__(self, order: list[str], state: T.StructType, millis: int | None):
        self.order, self.state, self.millis = order, state, millis
        self.columns = [*order, *(["time"] if millis else []), BODY]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.state)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best = None
        for piece in rows:  # one row is held, however many the key has
            some = piece[self.columns] if best is None else pd.concat([best, piece[self.columns]], ignore_index=True)
            best = in_order(iter([some]), self.order).iloc[-1:]
        if best is None:
            return
        known = self.last.get()
        if known is not None:
            both = pd.concat([best, pd.DataFrame([tuple(known)], columns=self.columns)], ignore_index=True)
            if in_order(iter([both]), self.order).index[-1] != 0:
                return
        row = best.iloc[0]
        if self.millis:
            if known is not None:
                self.handle.deleteTimer(int(known[self.columns.index("time")]) + self.millis)
            self.handle.registerTimer(int(row["time"]) + self.millis)
        self.last.update(tuple(row[c].item() if hasattr(row[c], "item") else row[c] for c in self.columns))
        yield pd.DataFrame({KEY: [key[0]], BODY: [row[BODY]]})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def latest_by_key_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], quiet_seconds: float | None = None
) -> DataFrame:
    """The ``values`` of a key's latest row by ``order``, each time a later one has come (update mode).

    A key's state is its latest row. With ``quiet_seconds`` it goes once the watermark is that far
    past the row's time, so state follows the keys in use, not all keys ever seen; a key that comes
    back after that starts anew. The stream then has a watermark on ``order[0]``, a timestamp.
    ``order`` must not be null. Start it under ``stateful_settings``; ``latest_to_table`` gathers
    what it emits.
    """
    extra = {}
    if quiet_seconds:
        # the column under the watermark must go along for timers to fire
        extra = {"time": F.unix_millis(F.col(order[0])), "watermarked": F.col(order[0])}
    packed, by = pack(df, keys, order, values, **extra)
    state = T.StructType([packed.schema[c] for c in [*by, *(["time"] if quiet_seconds else []), BODY]])
    emitted = packed.groupBy(KEY).transformWithStateInPandas(
        _Latest(by, state, int(quiet_seconds * 1000) if quiet_seconds else None),
        f"{KEY} string, {BODY} string",
        outputMode="Update",
        timeMode="EventTime" if quiet_seconds else "None",
    )
    return unpack(emitted, df, keys, [], values)
