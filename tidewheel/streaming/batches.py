"""Running totals and data-driven windows over a stream for keys of any size: each micro-batch
by the bounded operators.

A stateful processor takes all rows that a key has in a micro-batch into one task, which bounds
the micro-batch by its hottest key. Here every micro-batch goes through the operators of
:mod:`tidewheel.operators`, which cut hot keys, and stays in the JVM. What is carried from one to
the next is a table: totals by key, or the rows of windows that are still open. Each form either
runs to the end of what its source holds, or is started and runs on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewheel.operators.running import SPLIT_ROWS, Fold, find_hot_keys, running_fold
from tidewheel.operators.until import numbered_until
from tidewheel.storage import new_folder, remove_folder
from tidewheel.streaming.runner import BATCH, refuse_clash, stateful_settings, table_at, to_end
from tidewheel.streaming.totals import KeyedTotals, of_these_keys

_VALUE, _NEW, _ROWS = "__value", "__new", "__rows"
_LATEST = T.StructType([T.StructField("latest", T.LongType()), T.StructField("number", T.LongType())])


def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], folder: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def _rows_at(spark: SparkSession, folder: str, fields: Sequence[T.StructField], **added: T.DataType) -> DataFrame:
    new = [T.StructField(n, t) for n, t in {**added, BATCH: T.LongType()}.items()]
    return table_at(spark, f"{folder}/rows", T.StructType([*fields, *new])).drop(BATCH)


# --- running totals ---


def start_running_total(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    folder: str,
    value: Column | None = None,
    inclusive: bool = True,
    split_rows: int = SPLIT_ROWS,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Start writing the rows of ``stream`` with the key's total of ``value`` (default: 1) so far to
    ``folder`` (read them with :func:`running_total_rows`).

    ``every`` is how often a micro-batch starts, for sources without an end; with None the query
    ends with what its source holds now. Carried over is a table of totals (:class:`KeyedTotals`):
    a micro-batch reads the totals of its keys and writes what it adds to them. The total as
    carried joins the micro-batch as one row per key without order values, which sorts before all
    others, so it needs no join and no task of its own. A task gets some ``split_rows`` rows however
    large the micro-batch is. A retried micro-batch overwrites what it wrote. Started under ``stateful_settings`` if the stream itself has state.
    """
    keys, order = list(keys), list(order)
    value = F.lit(1) if value is None else value
    refuse_clash(stream, name, _VALUE, _NEW, _ROWS)
    totals = KeyedTotals(f"{folder}/totals", [stream.schema[k] for k in keys], [_VALUE, _ROWS])

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumns({_VALUE: value.cast("long"), _NEW: F.lit(1)})
        added = totals.add(rows.withColumn(_ROWS, F.lit(1).cast("long")), number)
        before, both = totals.before(batch.sparkSession, number), rows
        if before is not None:
            carried = of_these_keys(before, added, keys).drop(_ROWS).withColumn(_NEW, F.lit(0))
            both = rows.unionByName(carried, allowMissingColumns=True)
        # what each key adds is known by now, its number of rows too
        hot = find_hot_keys(both, keys, order, split_rows, counts=added.withColumnRenamed(_ROWS, "n"))
        fold = Fold(name, F.col(_VALUE), inclusive=inclusive)
        # the session's number of shuffle partitions may be that of the state, which does not grow with the input
        partitions = math.ceil((added.agg(F.sum(_ROWS)).first()[0] or 0) / split_rows)
        enough = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        counted = running_fold(both, keys, [*order, _NEW], [fold], hot, partitions if partitions > enough else None)
        new = counted.where(F.col(_NEW) == 1).select(*batch.columns, name)
        new.write.mode("overwrite").parquet(f"{folder}/rows/{BATCH}={number}")

    return _start(stream, write, folder, every)


def running_total_rows(spark: SparkSession, folder: str, stream_schema: T.StructType, name: str) -> DataFrame:
    """The rows that :func:`start_running_total` has written so far."""
    return _rows_at(spark, folder, stream_schema.fields, **{name: T.LongType()})


def running_total_by_batch(
    build: Callable[[], DataFrame],
    spark: SparkSession,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    value: Column | None = None,
    inclusive: bool = True,
    folder: str | None = None,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """:func:`start_running_total` run to the end of the stream that ``build`` makes; its rows."""
    folder = folder or new_folder(spark, "stream")
    with stateful_settings(spark):
        stream = build()
        query = start_running_total(stream, keys, order, name, folder, value, inclusive, split_rows, every=None)
    to_end(query)
    return running_total_rows(spark, folder, stream.schema, name)


# --- data-driven windows ---


def windows_until_by_batch(
    build: Callable[[], DataFrame],
    spark: SparkSession,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: str,
    folder: str | None = None,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Rows of the windows that the stream finished, with ``window_no`` as ``windows_until`` has it.

    ``trigger`` is an SQL condition. Each row is labelled and written once, when it comes: its
    window is the number of triggers before it, which does not change any more. Rows after a
    key's last trigger are left out when reading, by the total of triggers carried for the key.
    """
    folder = folder or new_folder(spark, "stream")
    flag = F.coalesce(F.expr(trigger).cast("long"), F.lit(0))
    rows = running_total_by_batch(build, spark, keys, order, "window_no", flag, False, folder, split_rows)
    hot = find_hot_keys(rows, keys, order, split_rows)
    totals = running_fold(rows, keys, order, [Fold("__windows", flag, whole=True)], hot)
    return totals.where(F.col("window_no") < F.col("__windows")).drop("__windows")


def start_windows(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: str,
    folder: str,
    max_events: int | None = None,
    seconds: float | None = None,
    delay: float = 0,
    split_rows: int = SPLIT_ROWS,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Start writing the rows of each window as it closes, with ``window_no`` (from 0 per key), to ``folder``.

    A window ends with a row for which the SQL condition ``trigger`` holds, or at ``max_events``
    rows, or ``seconds`` of event time after its first row; ``order`` is then led by that time, a
    timestamp. Time runs out when a row of the key comes that is late enough, or when the latest
    time of all rows so far less ``delay`` seconds has reached the limit. Rows without a time come
    first; they make windows of their own. A row whose time is before that of rows already written
    joins the rows of its key that still wait.

    Carried over are the rows of open windows, whole, and how many windows of each key have closed.
    Those rows go through the bounded operator again with the next micro-batch, which cuts hot keys.
    """
    keys, order = list(keys), list(order)
    refuse_clash(stream, "window_no", "__open", "__closed")
    if seconds and not isinstance(stream.schema[order[0]].dataType, T.TimestampType):
        raise TypeError(f"{order[0]} must be a timestamp")
    closed_before = KeyedTotals(f"{folder}/totals", [stream.schema[k] for k in keys], ["__closed"])
    numbered = T.StructType([*stream.schema.fields, T.StructField("window_no", T.LongType())])
    condition = F.expr(trigger)

    def write(batch: DataFrame, number: int) -> None:
        session, rows, watermark = batch.sparkSession, batch.select(*stream.columns), None
        if number:
            rows = rows.unionByName(table_at(session, f"{folder}/open/{(number - 1) % 2}", stream.schema, may_miss=False))
        # the time up to which all has come, by the micro-batches so far; one number
        time = F.unix_millis(F.max(order[0])) if seconds else F.lit(None)
        times = batch.agg(time.cast("long").alias("latest"))
        if number:
            times = times.union(table_at(session, f"{folder}/latest/{(number - 1) % 2}", _LATEST, may_miss=False).select("latest"))
        times = times.agg(F.max("latest").alias("latest"), F.lit(number).cast("long").alias("number"))
        times.write.mode("overwrite").parquet(f"{folder}/latest/{number % 2}")
        if seconds:
            latest = session.read.schema(_LATEST).parquet(f"{folder}/latest/{number % 2}").first()[0]
            watermark = None if latest is None else latest - int(delay * 1000)
        labelled = numbered_until(rows, keys, order, condition, max_events, seconds, watermark, split_rows)
        path = f"{folder}/labelled/{number % 2}"
        labelled.write.mode("overwrite").partitionBy("__open").parquet(path)
        kind = T.StructType([*numbered.fields, T.StructField("__open", T.BooleanType())])
        labelled = session.read.schema(kind).parquet(path)
        closed = labelled.where(~F.col("__open")).drop("__open")
        ends = closed.groupBy(*keys).agg((F.max("window_no") + 1).alias("__closed"))
        added = closed_before.add(ends, number)
        before = closed_before.before(session, number)
        if before is not None:
            # closed rows of a key meet the one number of its windows before, as a running total does
            carried = of_these_keys(before, added, keys).withColumn(_NEW, F.lit(0))
            both = closed.withColumn(_NEW, F.lit(1)).unionByName(carried, allowMissingColumns=True)
            hot = find_hot_keys(closed, keys, order, split_rows)
            fold = Fold("__before", F.coalesce("__closed", F.lit(0)))
            folded = running_fold(both, keys, [*order, _NEW], [fold], hot).where(F.col(_NEW) == 1)
            closed = folded.withColumn("window_no", F.col("window_no") + F.col("__before")).select(*numbered.names)
        closed.write.mode("overwrite").parquet(f"{folder}/rows/{BATCH}={number}")
        labelled.where("__open").select(*stream.columns).write.mode("overwrite").parquet(f"{folder}/open/{number % 2}")

    return _start(stream, write, folder, every)


def window_rows(spark: SparkSession, folder: str, stream_schema: T.StructType) -> DataFrame:
    """The rows of closed windows that :func:`start_windows` has written so far."""
    return _rows_at(spark, folder, stream_schema.fields, window_no=T.LongType())


def windows_by_batch(
    build: Callable[[], DataFrame],
    spark: SparkSession,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: str,
    folder: str | None = None,
    max_events: int | None = None,
    seconds: float | None = None,
    delay: float = 0,
    split_rows: int = SPLIT_ROWS,
    close: bool = False,
) -> DataFrame:
    """:func:`start_windows` run to the end of the stream that ``build`` makes; the rows of closed windows.

    With ``close`` the stream is taken to have ended for good: windows that only wait for their
    time come out too (those that wait for a trigger or the cap do not, as in a bounded input).
    They are added as read; the folder is left as it is.
    """
    folder = folder or new_folder(spark, "stream")
    with stateful_settings(spark):
        stream = build()
        query = start_windows(stream, keys, order, trigger, folder, max_events, seconds, delay, split_rows, every=None)
    to_end(query)
    rows = window_rows(spark, folder, stream.schema)
    if not (close and seconds):
        return rows
    both = table_at(spark, f"{folder}/latest/0", _LATEST).union(table_at(spark, f"{folder}/latest/1", _LATEST))
    last = both.agg(F.max("number")).first()[0]
    if last is None:
        return rows
    waiting = table_at(spark, f"{folder}/open/{last % 2}", stream.schema, may_miss=False)
    labelled = numbered_until(waiting, list(keys), list(order), F.expr(trigger), max_events, seconds, None, split_rows)
    keyed = KeyedTotals(f"{folder}/totals", [stream.schema[k] for k in keys], ["__closed"])
    names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    before = keyed.before(spark, last + 1).withColumnsRenamed(names)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    left = labelled.drop("__open").join(before, same, "left")
    number = F.col("window_no") + F.coalesce("__closed", F.lit(0))
    return rows.unionByName(left.withColumn("window_no", number).select(*rows.columns))


# --- late rows ---


def split_late_by_batch(
    build: Callable[[], DataFrame], spark: SparkSession, time: str, delay: float, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows) of a stream run to its end: together they are all rows.

    A row is late if its ``time`` (a timestamp) is before the watermark that the micro-batches
    before it have set: their latest time less ``delay`` seconds. Spark drops such rows from
    stateful operators; here they are a table of their own. Rows without a time are not late.
    """
    folder = folder or new_folder(spark, "stream")
    with stateful_settings(spark):
        stream = build()
        query = start_split_late(stream, time, delay, folder, every=None)
    to_end(query)
    rows = _rows_at(spark, folder, stream.schema.fields, __late=T.BooleanType())
    return rows.where(~F.col("__late")).drop("__late"), rows.where("__late").drop("__late")


def start_split_late(stream: DataFrame, time: str, delay: float, folder: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Start writing rows in time and late rows to ``folder/rows/__batch=N/__late=false`` and ``=true``."""
    refuse_clash(stream, "__late")
    if not isinstance(stream.schema[time].dataType, T.TimestampType):
        raise TypeError(f"{time} must be a timestamp")

    def write(batch: DataFrame, number: int) -> None:
        session, before = batch.sparkSession, None
        times = batch.agg(F.unix_micros(F.max(time)).alias("latest"))
        if number:
            earlier = table_at(session, f"{folder}/latest/{(number - 1) % 2}", _LATEST, may_miss=False).select("latest")
            before = earlier.first()[0]
            times = times.union(earlier)
        late = F.lit(False)
        if before is not None:
            late = F.coalesce(F.unix_micros(time) < before - int(delay * 1e6), F.lit(False))
        rows = batch.withColumn("__late", late)
        rows.write.mode("overwrite").partitionBy("__late").parquet(f"{folder}/rows/{BATCH}={number}")
        times = times.agg(F.max("latest").alias("latest"), F.lit(number).cast("long").alias("number"))
        times.write.mode("overwrite").parquet(f"{folder}/latest/{number % 2}")

    return _start(stream, write, folder, every)


def forget(spark: SparkSession, folder: str) -> None:
    """Remove what a by-batch run has written: rows, carried tables and checkpoint. For the caller who is done with it."""
    remove_folder(spark, folder)
