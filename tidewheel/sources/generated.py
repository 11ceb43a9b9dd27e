"""Rows that come from the program itself: given values, sequences, generators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def rows_of(spark: SparkSession, values: Sequence, schema: str | T.DataType = "value string") -> DataFrame:
    """Given values as a frame; single values become one-column rows. Must not be empty."""
    if not values:
        raise ValueError("an in-memory source needs at least one value")
    rows = [v if isinstance(v, (tuple, dict)) else (v,) for v in values]
    return spark.createDataFrame(rows, schema)


def sequence(spark: SparkSession, first: int, last: int, partitions: int | None = None) -> DataFrame:
    """``first..last``, both included, in column ``n``; each partition is one ordered run."""
    return spark.range(first, last + 1, 1, partitions).withColumnRenamed("id", "n")


def rate_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """An endless generated stream ``(timestamp, value)``."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


class _Run(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _SequenceReader(DataSourceReader):
    BATCH = 1 << 16

    def __init__(self, options: dict[str, str]):
        self.first = int(options.get("from", "1"))
        self.last = int(options["to"])
        self.parts = max(1, int(options.get("partitions", "1")))

    def partitions(self) -> list[_Run]:
        size = self.last - self.first + 1
        cuts = [self.first + size * i // self.parts for i in range(self.parts + 1)]
        return [_Run(a, b - 1) for a, b in zip(cuts, cuts[1:]) if a < b]

    def read(self, partition: _Run) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for start in range(partition.first, partition.last + 1, self.BATCH):
            stop = min(start + self.BATCH, partition.last + 1)
            yield pa.record_batch([pa.array(np.arange(start, stop, dtype="int64"))], names=["n"])


class SequenceSource(DataSource):
    """A user-defined source on the public data source API: the sequence in Arrow batches.

    Shows how to plug in a source of one's own. For plain sequences use :func:`sequence`,
    which is built in and faster.
    """

    @classmethod
    def name(cls) -> str:
        return "tidewheel_sequence"

    def schema(self) -> str:
        return "n bigint"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SequenceReader(self.options)


def register_sequence_source(spark: SparkSession) -> str:
    """Register :class:`SequenceSource`; returns the format name to load it by."""
    spark.dataSource.register(SequenceSource)
    return SequenceSource.name()
