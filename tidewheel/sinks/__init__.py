"""Ways out: print, collect a few rows, delimited text, topics, a function per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidewheel.storage import new_folder


def print_rows(df: DataFrame, n: int | None = None, mode: str = "append") -> StreamingQuery | None:
    """Print all rows, or the first ``n``; a stream does so for each micro-batch until it is stopped.

    Rows come to the client a partition at a time.
    """

    def told(rows: DataFrame, _: int = 0) -> None:
        print("\t".join(rows.columns))
        for row in (rows if n is None else rows.limit(n)).toLocalIterator():
            print("\t".join(map(str, row)))

    if df.isStreaming:
        return df.writeStream.foreachBatch(told).outputMode(mode).start()
    told(df)
    return None


def collect_limited(df: DataFrame, n: int, mode: str = "append") -> list[Row]:
    """Up to ``n`` rows on the client. A stream runs until it has given ``n`` rows and is stopped
    then, so it must not end before."""
    if not df.isStreaming:
        return df.limit(n).collect()
    got: dict[int, list[Row]] = {}  # by micro-batch, as one may come again

    def take(batch: DataFrame, number: int) -> None:
        missing = n - sum(len(rows) for other, rows in got.items() if other != number)
        got[number] = batch.limit(missing).collect() if missing > 0 else []

    query = each_batch(df, take, new_folder(df.sparkSession, "collect"), mode).start()
    try:
        while sum(map(len, got.values())) < n and query.isActive:
            query.awaitTermination(0.2)
    finally:
        query.stop()
    return [row for number in sorted(got) for row in got[number]]


def delimited(df: DataFrame, separator: str = " ") -> DataFrame:
    """Each row as one line of text. Nothing is quoted; a null is an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(separator, *fields).alias("value"))


def write_delimited(df: DataFrame, path: str, separator: str = " ", mode: str = "errorifexists") -> None:
    """Text files of :func:`delimited` lines under ``path``, one per partition."""
    delimited(df, separator).write.mode(mode).text(path)


def topic_rows(df: DataFrame, value: str | Column, key: str | Column | None = None) -> DataFrame:
    """The columns the Kafka sink takes: ``value``, and ``key`` where messages need affinity."""
    def text(c: str | Column, name: str) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("string").alias(name)

    return df.select(*([] if key is None else [text(key, "key")]), text(value, "value"))


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """A bounded frame of :func:`topic_rows` to a topic; also what :func:`each_batch` can call."""
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def stream_to_topic(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """A stream of :func:`topic_rows` to a topic, at least once; call ``start()`` on the result."""
    return (
        rows.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def stream_to_files(df: DataFrame, folder: str, checkpoint: str, format: str = "parquet") -> DataStreamWriter:
    """A stream to files, exactly once; call ``start()`` on the result."""
    return df.writeStream.format(format).option("path", folder).option("checkpointLocation", checkpoint)


def each_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """A stream to a function of (micro-batch, its number). A micro-batch may come again after a
    failure with the same number, so ``write`` must be idempotent for exactly-once results."""
    return df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
