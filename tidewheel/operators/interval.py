"""Interval join: rows of two sides with equal keys whose times lie within bounds of each other.

Bounded sides are joined by key and time bucket, an equi-join: a bucket is as long as the
interval, so a left row meets two buckets at most and a right row lies in one. A key that holds a
third of all rows falls apart by its buckets. A bucket in which a side still has more than
``split_rows`` rows of one key is cut into blocks: rows of that side are dealt to parts by hash,
and rows of the other side go to each part. Streams are joined by Spark's own stream-stream join,
whose state goes as the watermarks pass.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions.numbers import micros

SPLIT_ROWS = 100_000
_UNITS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}


def interval_micros(text: str) -> int:
    """``'10 minutes'`` or ``'-1 hour'`` in microseconds."""
    found = re.fullmatch(r"\s*([+-]?\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not found or found[2] not in _UNITS:
        raise ValueError(f"not an interval of a fixed length: {text!r}")
    return int(found[1]) * _UNITS[found[2]]


def _within(left_time: Column, right_time: Column, lower: str, upper: str) -> Column:
    return (right_time >= left_time + F.expr(f"INTERVAL {lower}")) & (right_time <= left_time + F.expr(f"INTERVAL {upper}"))


def _check(left: DataFrame, right: DataFrame, keys: Sequence[str], lower: str, upper: str) -> int:
    if clash := (set(left.columns) & set(right.columns)) - set(keys):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    width = interval_micros(upper) - interval_micros(lower)
    if width < 0:
        raise ValueError("the interval ends before it starts")
    return width


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower: str,
    upper: str,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Pairs of rows with equal ``keys`` and ``right_time`` from ``left_time + lower`` to ``left_time + upper``.

    Both bounds belong to the interval. The keys come once; other columns must differ in name.
    Null keys and null times join with nothing. Times are timestamps of one kind. Works on
    streams, too, whose rows must come with watermarks on both times (:func:`stream_interval_join`).
    """
    keys = list(keys)
    if left.isStreaming or right.isStreaming:
        return stream_interval_join(left, right, keys, left_time, right_time, lower, upper)
    width = max(1, _check(left, right, keys, lower, upper))

    def timed(df: DataFrame, time: str, name: str) -> DataFrame:
        at = micros(time, df.schema[time].dataType)
        if at is None:
            raise TypeError(f"{time} must be a timestamp")
        return df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, time])).withColumn(name, at)

    def bucket(at: Column) -> Column:
        return at - F.pmod(at, F.lit(width).cast("long"))

    ends = [F.col("__left_at") + F.lit(interval_micros(b)).cast("long") for b in (lower, upper)]
    asked = timed(left, left_time, "__left_at").withColumn("__bucket", F.explode(F.array_distinct(F.array(*map(bucket, ends)))))
    held = timed(right, right_time, "__right_at").withColumn("__bucket", bucket(F.col("__right_at")))
    cell = [*keys, "__bucket"]
    asked, held = _dealt(asked, held, cell, split_rows)
    other = {c: f"__right_{i}" for i, c in enumerate([*cell, "__part"])}
    same = [F.col(k) == F.col(o) for k, o in other.items()]
    near = F.col("__right_at").between(*ends)
    joined = asked.join(held.withColumnsRenamed(other), [*same, near])
    return joined.select(*left.columns, *[c for c in right.columns if c not in keys])


def _dealt(asked: DataFrame, held: DataFrame, cell: list[str], split_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__part``, so that the rows of a cell and part are few.

    Rows are counted per cell, combined before the shuffle. Only cells of more than ``split_rows``
    rows on a side come to the client, as a hash code and two numbers: at most one for
    ``split_rows`` rows.
    """
    spark = asked.sparkSession

    def large(df: DataFrame, name: str) -> DataFrame:
        code = F.xxhash64(*cell).alias("__code")
        return df.groupBy(code).agg(F.ceil(F.count("*") / split_rows).cast("int").alias(name)).where(F.col(name) > 1)

    found = large(asked, "__rows").join(large(held, "__columns"), "__code", "full").na.fill(1, ["__rows", "__columns"])
    cells = found.collect()
    one = F.lit(0).cast("long")
    if not cells:
        return asked.withColumn("__part", one), held.withColumn("__part", one)
    kind = T.StructType([T.StructField("__code", T.LongType()), T.StructField("__rows", T.IntegerType()), T.StructField("__columns", T.IntegerType())])
    table = F.broadcast(spark.createDataFrame([tuple(r) for r in cells], kind))

    def deal(df: DataFrame, own: str, others: str, own_step: Column, other_step: Column) -> DataFrame:
        names = df.columns
        marked = df.withColumn("__code", F.xxhash64(*cell)).join(table, "__code", "left").na.fill(1, ["__rows", "__columns"])
        mine = F.pmod(F.xxhash64(*[c for c in names if c != "__bucket" and not isinstance(df.schema[c].dataType, T.MapType)]), F.col(own)).cast("long")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others).cast("long") - 1))
        dealt = marked.withColumn("__mine", mine).withColumn("__met", every)
        return dealt.withColumn("__part", F.col("__mine") * own_step + F.col("__met") * other_step).select(*names, "__part")

    columns = F.col("__columns").cast("long")
    return deal(asked, "__rows", "__columns", columns, F.lit(1)), deal(held, "__columns", "__rows", F.lit(1), columns)


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower: str,
    upper: str,
    how: str = "inner",
) -> DataFrame:
    """:func:`interval_join` of two streams with watermarks on their times (or of a stream with a frame).

    A row waits in the state until the watermarks say that nothing more can meet it. With
    ``how='left_outer'`` a left row without a partner comes out then.
    """
    keys = list(keys)
    _check(left, right, keys, lower, upper)
    other = {k: f"__right_{i}" for i, k in enumerate(keys)}
    names = [*left.columns, *[c for c in right.columns if c not in keys]]
    right = right.withColumnsRenamed(other)
    same = [F.col(k) == F.col(o) for k, o in other.items()]
    joined = left.join(right, [*same, _within(F.col(left_time), F.col(right_time), lower, upper)], how)
    return joined.select(*names)
