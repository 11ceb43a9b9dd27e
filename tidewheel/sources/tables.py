"""A streaming source of one's own, on the public data source API: a table that grows by files.

The offset is how many row groups of each file have been given, so a restart from the checkpoint
neither repeats nor skips one; each row group is a partition of its micro-batch. Files are taken in
the order of their names and never change once they are there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "tidewheel_table"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class RowGroup(InputPartition):
    file: str
    number: int


class TableReader(DataSourceStreamReader):
    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names
        self.known: dict[str, int] = {}  # row groups of files seen before

    def _sizes(self) -> dict[str, int]:
        files, root = _opened(self.path)
        info = files.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        for f in found:
            if f.type == fs.FileType.File and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")) and f.path not in self.known:
                self.known[f.path] = pq.ParquetFile(f.path, filesystem=files).metadata.num_row_groups
        return dict(sorted(self.known.items()))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self._sizes()

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        return [RowGroup(name, i) for name, size in sorted(end.items()) for i in range(start.get(name, 0), size)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        files, _ = _opened(self.path)
        yield from pq.ParquetFile(partition.file, filesystem=files).iter_batches(row_groups=[partition.number], columns=self.names)

    def commit(self, end: dict) -> None: ...

    def stop(self) -> None: ...


class TableSource(DataSource):
    """``spark.readStream.format("tidewheel_table").schema(…).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> TableReader:
        return TableReader(self.options["path"], schema.fieldNames())


def stream_row_groups(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet files at ``path``, a file or a folder that files come into, as a stream by row groups."""
    spark.dataSource.register(TableSource)
    return spark.readStream.format(FORMAT).schema(schema).load(path)
