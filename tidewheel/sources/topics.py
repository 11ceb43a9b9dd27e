"""Kafka topics and sockets. The Kafka connector is a separate package of Spark
(``spark-sql-kafka-0-10``); what follows the source works on any frame of its row schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed by the Kafka connector.
TOPIC_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def topic_options(
    servers: str,
    topic: str,
    group: str | None = None,
    start: str = "latest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``start`` is ``latest`` or ``earliest``; it only counts on the first
    run, later runs go on from the checkpoint. ``max_per_trigger`` bounds a micro-batch and
    ``min_partitions`` splits topic partitions that are too large for one task."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def watch_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """A topic as a stream of :data:`TOPIC_ROW` rows; see :func:`topic_options`."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **settings)).load()


def read_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """What a topic holds now, as a bounded frame (a bounded read starts at ``earliest``)."""
    settings.setdefault("start", "earliest")
    return spark.read.format("kafka").options(**topic_options(servers, topic, **settings)).load()


def topic_values(rows: DataFrame, with_position: bool = False) -> DataFrame:
    """The message values as text; ``with_position`` keeps what orders messages of a key."""
    columns = [F.col("value").cast("string").alias("value")]
    if with_position:
        columns += [F.col("partition"), F.col("offset")]
    return rows.select(*columns)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket. Spark's socket source cannot replay, so it is for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
