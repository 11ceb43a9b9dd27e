"""A file sink of one's own with a commit protocol, on the public data source API.

A task writes a Parquet file of its own name under ``data``, which nobody reads yet. When all tasks
of a micro-batch are done, its commit writes one small manifest with their names, by renaming it
into place; readers go by manifests only. A micro-batch that comes again finds its manifest and
takes its new files back; one that is aborted takes back what its tasks had written; files of tasks
that were lost with their executor are never listed. So each micro-batch is there once or not at all.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "tidewheel_committed"
_ROWS = 1 << 16


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/").removeprefix("file://") if path.startswith("file:///") else path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage | None:
        """One file for the task's rows, closed before its name is given away; none if there are no rows."""
        files, root = _opened(self.path)
        name, writer, rows = f"part-{uuid.uuid4().hex}.parquet", None, 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                files.create_dir(f"{root}/data", recursive=True)
                writer = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=files)
            writer.write_batch(batch, row_group_size=_ROWS)
            rows += batch.num_rows
        if writer is None:
            return None
        writer.close()
        return Written(name, rows)

    def _take_back(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = _opened(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{root}/data/{m.file}")

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        files, root = _opened(self.path)
        manifest = f"{root}/commits/{batchId:012d}.json"
        if files.get_file_info(manifest).type != fs.FileType.NotFound:
            self._take_back(messages)
            return
        files.create_dir(f"{root}/commits", recursive=True)
        lines = [json.dumps({"batch": batchId, "file": m.file, "rows": m.rows}) for m in messages if m is not None]
        draft = f"{root}/commits/.{batchId:012d}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write("".join(f"{line}\n" for line in lines).encode())
        files.move(draft, manifest)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self._take_back(messages)


class CommittedSink(DataSource):
    """``df.writeStream.format("tidewheel_committed").option("path", …)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"])


def register_committed_sink(spark: SparkSession) -> str:
    """Register :class:`CommittedSink`; returns the format name to write by."""
    spark.dataSource.register(CommittedSink)
    return FORMAT


def committed_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed micro-batches. The client holds the names of their files."""
    files, root = _opened(path)
    found = files.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    names = []
    for info in sorted(found, key=lambda i: i.path):
        if info.base_name.endswith(".json") and not info.base_name.startswith("."):
            with files.open_input_stream(info.path) as lines:
                names += [json.loads(line)["file"] for line in lines.read().decode().splitlines()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/data/{n}" for n in names])
