"""Per-key aggregates and how rows are laid out over partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.numbers import as_one_number


def count_by(df: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    """Rows per key. Spark counts within each input partition first, so a key that holds a
    third of the rows reaches the shuffle as one partial count per partition."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def in_one(df: DataFrame, columns: Sequence[str]) -> Column:
    """What to compare several columns as. A single number or time stays as it is, and a time
    with a whole number makes one decimal, so that Spark aggregates by hash; it sorts first for
    structs and strings."""
    if len(columns) == 1:
        return F.col(columns[0])
    number = as_one_number(df, columns)
    return F.struct(*columns) if number is None else number


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The ``values`` of each key's last row by ``order``; also combined before the shuffle.

    A single number or time as the value is aggregated by hash. Texts and several values are
    carried as they are, which makes Spark sort each input partition first.
    """
    if len(values) == 1:
        return df.groupBy(*keys).agg(F.max_by(values[0], in_one(df, order)).alias(values[0]))
    last = F.max_by(F.struct(*values), in_one(df, order)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*")


def partition_by_key(df: DataFrame, *keys: str | Column, partitions: int | None = None) -> DataFrame:
    """All rows of a key in one partition.

    This is what the caller asks for by name: a consumer that relies on key affinity. No
    other operator here uses it, because one hot key makes one hot partition.
    """
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def rebalance(df: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt out evenly, whatever their keys."""
    return df.repartition(partitions)
