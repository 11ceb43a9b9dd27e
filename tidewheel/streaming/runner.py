"""Drive a stream over what its source holds now and read the result back as a table.

The table and the checkpoint are in the folder shared by the cluster, so a lost executor costs
a retry and a lost driver a restart from the checkpoint. Nothing is gathered on the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewheel.storage import new_folder

# Setting names and the class are Spark's own.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


@contextmanager
def stateful_settings(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings for building and starting a stateful query; put back afterwards.

    State is kept on disk with only changes uploaded. The number of state partitions is fixed
    by the first run of a checkpoint, so it is chosen here: by default one per core.
    """
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    wanted = {**_STATE, "spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait until a query with the ``availableNow`` trigger has taken in everything."""
    query.awaitTermination()
    return query


# The folder column of a micro-batch's own directory; no column of a stream may have this name.
BATCH = "__batch"


def refuse_clash(stream: DataFrame, *reserved: str) -> None:
    """Raise if the stream has a column of a reserved name."""
    if clash := set(stream.columns) & {BATCH, *reserved}:
        raise ValueError(f"reserved column names: {sorted(clash)}")


def table_at(spark: SparkSession, path: str, schema: T.StructType, may_miss: bool = True) -> DataFrame:
    """A table that a stream has written, empty if the stream had nothing to write yet.

    With ``may_miss`` off a missing table is an error: what was written there is lost.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or not may_miss:
            raise
        return spark.createDataFrame([], schema)


def append_to_table(
    build: Callable[[], DataFrame], spark: SparkSession, folder: str | None = None, state_partitions: int | None = None
) -> DataFrame:
    """Run a stream in append mode to its end; the rows it emitted, each exactly once.

    ``build`` makes the streaming frame (under :func:`stateful_settings`). Running again with
    the same ``folder`` goes on from the checkpoint.
    """
    folder = folder or new_folder(spark, "stream")
    with stateful_settings(spark, state_partitions):
        stream = build()
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{folder}/rows")
        )
    to_end(query)
    return table_at(spark, f"{folder}/rows", stream.schema)


def append_and_close(
    source: Callable[[], DataFrame],
    build: Callable[[DataFrame], DataFrame],
    spark: SparkSession,
    time: str,
    folder: str | None = None,
    state_partitions: int | None = None,
    closing_time: dt.datetime = dt.datetime(2262, 1, 1),
) -> DataFrame:
    """:func:`append_to_table` for a stream that has an end: what is still open then comes out too.

    ``source`` makes the stream and ``build`` the frame from it, watermark on ``time`` included.
    Once the source is read, one row of nulls with ``closing_time`` as its time moves the watermark
    past all that is open. Its own window stays open, so it is in no result. The stream is closed
    for good: rows that come to the source later are late. (Python holds times up to April 2262.)
    """
    folder = folder or new_folder(spark, "stream")
    schema = source().schema
    if not isinstance(schema[time].dataType, T.TimestampType):
        raise TypeError(f"{time} must be a timestamp")
    closing = f"{folder}/closing"
    rows_of_closing = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    def put(rows: list[tuple]) -> None:
        spark.createDataFrame(rows, rows_of_closing).coalesce(1).write.mode("append").parquet(closing)

    def both() -> DataFrame:
        return build(source().unionByName(spark.readStream.schema(rows_of_closing).parquet(closing)))

    put([])
    append_to_table(both, spark, folder, state_partitions)
    put([tuple(closing_time if f.name == time else None for f in schema)])
    return append_to_table(both, spark, folder, state_partitions)


def latest_to_table(
    build: Callable[[], DataFrame],
    spark: SparkSession,
    keys: Sequence[str],
    folder: str | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """Run an aggregation in update mode to its end; the last value of each key.

    Each micro-batch writes only the keys it changed, into a directory of its own that a
    retry overwrites.
    """
    folder = folder or new_folder(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/{BATCH}={batch_id}")

    with stateful_settings(spark, state_partitions):
        stream = build()
        refuse_clash(stream)
        query = (
            stream.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    to_end(query)
    schema = T.StructType([*stream.schema.fields, T.StructField(BATCH, T.LongType())])
    rest = [c for c in stream.columns if c not in keys]
    versions = table_at(spark, f"{folder}/rows", schema)
    return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("v")).select(*keys, "v.*")
