"""The jobs users run, each a short chain of operators.

A job that takes and returns frames serves bounded and streaming input; the ``watch_*`` jobs
only put a streaming source in front.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidewheel import sinks, sources
from tidewheel.functions import fold_sequence, location_sentence, records_to_json, show_upper, with_prefix
from tidewheel.operators import (
    count_by,
    gather_windows,
    lines_starting_with,
    locations_flagged,
    parse_flagged,
    parse_locations,
    rebalance,
    running_words,
    split_words,
    tokenize,
    tumbling,
    tumbling_last,
    upper_lines,
    with_event_time,
)
from tidewheel.storage import new_folder
from tidewheel.streaming import append_to_table, running_total_by_batch, start_running_total, windows_by_batch, windows_until_stream

PERSON = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("name", T.StringType()),
    ]
)
PATIENT_EVENT = T.StructType([T.StructField(n, T.StringType()) for n in ("patientId", "position", "status")])


# --- text ---


def hello(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """Given strings in upper case."""
    return upper_lines(sources.rows_of(spark, words))


def letters(lines: DataFrame, partitions: int | None = None, text: str = "value") -> DataFrame:
    """``[v] => V`` of each value, optionally dealt out over ``partitions`` first."""
    spread = rebalance(lines, partitions) if partitions else lines
    return spread.select(show_upper(F.col(text)).alias(text))


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Normalised words and how often each occurs.

    Bounded: the final counts. Streaming, in update mode: the new total of each word that a
    micro-batch changed.
    """
    return count_by(tokenize(lines, text), "word")


def plain_word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """The same over white-space separated words as they stand."""
    return count_by(split_words(lines, text), "word")


def running_word_count(lines: DataFrame, order: Sequence[str], text: str = "value", plain: bool = False) -> DataFrame:
    """Each word of each line as a row with how often it has come up to there.

    ``order`` are columns that say in which order the lines came (end it with a unique one).
    They stay, with ``position``, the word's place in its line.
    """
    return running_words(lines, order, text, plain)


def running_word_count_to_table(
    build: Callable[[], DataFrame], spark: SparkSession, order: Sequence[str], text: str = "value", plain: bool = False
) -> DataFrame:
    """The same over a stream of lines run to its end: a row for each word of each line, whose
    count goes on from micro-batch to micro-batch."""

    def words() -> DataFrame:
        return (split_words if plain else tokenize)(build(), text, order, "position")

    return running_total_by_batch(words, spark, ["word"], [*order, "position"], "cnt")


def start_running_word_count(
    lines: DataFrame, order: Sequence[str], folder: str, text: str = "value", plain: bool = False, every: str = "10 seconds"
) -> StreamingQuery:
    """The same over a stream without an end, started: read what has been counted so far with
    ``streaming.running_total_rows``."""
    words = (split_words if plain else tokenize)(lines, text, order, "position")
    return start_running_total(words, ["word"], [*order, "position"], "cnt", folder, every=every)


def socket_word_count(spark: SparkSession, host: str, port: int, plain: bool = False) -> DataFrame:
    """Either word count over a socket, to be started in update mode."""
    lines = sources.socket_lines(spark, host, port)
    return plain_word_count(lines) if plain else word_count(lines)


def socket_upper(spark: SparkSession, host: str, port: int) -> DataFrame:
    return upper_lines(sources.socket_lines(spark, host, port))


def prefix_line_count(lines: DataFrame, prefix: str = "N", text: str = "value") -> DataFrame:
    """How often each line that starts with ``prefix`` occurs."""
    return count_by(lines_starting_with(lines, prefix, text), text)


def prefix_line_count_to_text(lines: DataFrame, output: str, prefix: str = "N") -> None:
    """The same written as ``line count`` text lines."""
    sinks.write_delimited(prefix_line_count(lines, prefix), output)


# --- watched folders (the look-up interval is the trigger they are started with) ---

WATCH_INTERVAL = "10 seconds"


def watch_people(spark: SparkSession, folder: str, **limits: str | int) -> DataFrame:
    """Typed person records of a folder that new CSV files come into."""
    return sources.watch_csv(spark, folder, PERSON, **limits)


def start_watch(df: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """A watched source to files, looking for new input every :data:`WATCH_INTERVAL`."""
    return sinks.stream_to_files(df, folder, checkpoint).trigger(processingTime=WATCH_INTERVAL)


# --- event-time windows ---


def sequence_windows(numbers: DataFrame, half: int, n: str = "n", delay: str | None = "1 second") -> DataFrame:
    """Numbers as out-of-order event times, the last one in each 3 s window, as text."""
    timed = numbers.select(n, fold_sequence(F.col(n), half).alias("v"))
    timed = with_event_time(timed, F.timestamp_millis("v"), delay)
    last = tumbling_last(timed, "3 seconds", "v", ["ts", n])
    return last.select("window_start", with_prefix("Window closed at event-time ", F.col("last")).alias("message"))


# --- topics ---


def topic_to_topic(messages: DataFrame) -> DataFrame:
    """Topic rows to topic rows, one to one, the text in upper case."""
    return sinks.topic_rows(upper_lines(sources.topic_values(messages)), "value")


def watch_topic_to_topic(
    spark: SparkSession, servers: str, source: str, target: str, checkpoint: str, **settings
) -> DataStreamWriter:
    messages = sources.watch_topic(spark, servers, source, **settings)
    return sinks.stream_to_topic(topic_to_topic(messages), servers, target, checkpoint)


def patient_events(messages: DataFrame) -> DataFrame:
    """Topic rows as patient events: ``partition, offset, patientId, position, status``, and ``unread``
    with the message as it came (``value``) where it could not be read."""
    values = sources.topic_values(messages, with_position=True)
    flagged = parse_flagged(values, PATIENT_EVENT)
    return flagged.select("partition", "offset", "record.*", "unread", F.when(F.col("unread"), F.col("value")).alias("value"))


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events that could be read, quarantine: ``partition, offset, value``)."""
    read = events.where(~F.col("unread")).drop("unread", "value")
    return read, events.where("unread").select("partition", "offset", "value")


def patient_windows(messages: DataFrame, trigger_status: str = "X") -> tuple[DataFrame, DataFrame]:
    """(rows of each patient's window, messages that could not be read) on a stream of topic rows
    (start under ``streaming.stateful_settings``). A patient's messages are in one topic partition,
    so ``partition, offset`` is the order they came in. The two are streams of their own."""
    flat, bad = split_events(patient_events(messages))
    rows = windows_until_stream(
        flat, ["patientId"], ["partition", "offset"], F.col("status") == trigger_status, ["position", "status"]
    )
    return rows, bad


def patient_windows_to_table(
    build: Callable[[], DataFrame], spark: SparkSession, trigger_status: str = "X", folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows of each patient's window, messages that could not be read) of a stream of topic rows run to
    its end, by micro-batch: hot patients are cut, and no state is kept in Python."""
    folder = folder or new_folder(spark, "patients")
    split = lambda: split_events(patient_events(build()))
    condition = f"status = '{trigger_status}'"
    rows = windows_by_batch(lambda: split()[0], spark, ["patientId"], ["partition", "offset"], condition, f"{folder}/windows")
    return rows, append_to_table(lambda: split()[1], spark, f"{folder}/unread")


def patient_window_messages(rows: DataFrame, order: Sequence[str] = ("place",)) -> DataFrame:
    """Window rows (of one micro-batch, or of a table) as one JSON list per window."""
    windows = gather_windows(rows, ["patientId"], order, ["patientId", "position", "status"])
    value = records_to_json(F.col("events"))
    return sinks.topic_rows(windows.withColumn("value", value), "value", "patientId")


def watch_patient_windows(
    spark: SparkSession, servers: str, source: str, target: str, unread: str, checkpoint: str, **settings
) -> tuple[DataStreamWriter, DataStreamWriter]:
    """The whole chain, topic to topic, and the stream of messages that could not be read to the topic
    ``unread``. All rows of a window are in one micro-batch, so the list is made there, by a plain
    aggregate."""
    rows, bad = patient_windows(sources.watch_topic(spark, servers, source, **settings))

    def write(batch: DataFrame, _: int) -> None:
        sinks.write_topic(patient_window_messages(batch), servers, target)

    quarantine = sinks.stream_to_topic(sinks.topic_rows(bad, "value"), servers, unread, f"{checkpoint}/unread")
    return sinks.each_batch(rows, write, f"{checkpoint}/windows"), quarantine


# --- locations ---


def location_lines_flagged(messages: DataFrame, text: str = "value") -> DataFrame:
    """``messages`` with ``line``, a sentence per location message, and ``unread``: whether the message
    could not be read or lacks a field. One frame, one parse; every message is in it."""
    found = locations_flagged(messages, text)
    unread = F.col("unread") | F.col("patientId").isNull() | F.col("lat").isNull() | F.col("lon").isNull()
    sentence = location_sentence(F.col("patientId"), F.col("lat"), F.col("lon"))
    return found.select(*messages.columns, F.when(~unread, sentence).alias("line"), unread.alias("unread"))


def location_lines(messages: DataFrame, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(a sentence per location message, messages that could not be read or lack a field).

    With ``fail_fast`` the job stops at a message that is no JSON object."""
    if fail_fast:
        parse, _ = parse_locations(messages, fail_fast=True)
        readable = F.col("patientId").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
        sentence = location_sentence(F.col("patientId"), F.col("lat"), F.col("lon"))
        return parse.where(readable).select(sentence.alias("value")), messages.where(F.lit(False))
    flagged = location_lines_flagged(messages)
    return flagged.where(~F.col("unread")).select(F.col("line").alias("value")), flagged.where("unread").select(*messages.columns)


def average_location(locations: DataFrame, size: str = "5 minutes", time: str = "ts") -> DataFrame:
    """Mean position per patient and window."""
    means = [F.avg("lat").alias("lat"), F.avg("lon").alias("lon")]
    return tumbling(locations, size, means, ["patientId"], time)
