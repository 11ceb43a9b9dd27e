"""The running count as a stream that answers every record."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewheel.streaming.packing import BODY, KEY, in_order, pack, unpack

_STATE = T.StructType([T.StructField("n", T.LongType())])


class _RunningCount(StatefulProcessor):
    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf, so_far = in_order(rows, self.order), self.total.get()
        seen = int(so_far[0]) if so_far else 0
        self.total.update((seen + len(pdf),))
        yield pd.DataFrame({KEY: key[0], "n": np.arange(seen + 1, seen + len(pdf) + 1), BODY: pdf[BODY].to_numpy()})

    def close(self) -> None:
        pass


def running_count_stream(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "cnt") -> DataFrame:
    """Each row of the stream with its key's count so far, across micro-batches.

    ``operators.count_by`` in update mode is cheaper and gives one total per key and
    micro-batch; use this where each record must be answered. The rows one key has in one
    micro-batch are sorted in memory, so bound micro-batches at the source
    (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``). Start it under ``stateful_settings``.
    """
    packed, by = pack(df, keys, order, df.columns)
    counted = packed.groupBy(KEY).transformWithStateInPandas(
        _RunningCount(by), f"{KEY} string, n bigint, {BODY} string", outputMode="Append", timeMode="None"
    )
    return unpack(counted, df, keys, ["n"], df.columns).withColumnRenamed("n", name).select(*df.columns, name)
