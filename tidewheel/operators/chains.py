"""Greedy chains: the first value of each group, then always the first at least ``step`` after the one before.

Each link depends on the one before it, so a chain is followed in order, which is right within
one task for ordinary groups. A group of more than ``split_rows`` values is cut into slices by
value, and the chain is found without walking it:

1. in each slice, every value at which the chain could come in (those within ``step`` of the
   slice's first, and the next) is sent to the last link it leads to there, by doubling pointers,
   and so to the bound that the first link beyond the slice must reach;
2. these bounds are looked up in the slices they fall in, which gives a jump table: from a value
   where the chain may enter a slice to the value where it then enters a later one;
3. the jump table is squared until its jumps span all slices of a group; read from the longest
   jumps to the shortest, the tables give every value where the chain really enters a slice;
4. each slice with an entry is followed from there, all slices at once.

The tables hold at most one row for each value, and as good as always far fewer; the number of
joins grows as the logarithm of the number of slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators.running import HotKeys, _with_slices, find_hot_keys
from tidewheel.storage import stored

_SLICE = "__slice0"
_AT, _TO = "__at", "__to"


def _starts_of_groups(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Rows at which the values of ``names`` change, with row 0. Nulls are equal."""
    ends = [pc.run_end_encode(batch.column(n)).run_ends.to_numpy() for n in names]
    return np.concatenate([[0], np.unique(np.concatenate(ends))[:-1]])


def _window_starts(group_by: Sequence[str], millis: int, value: str = "__ms"):
    """Thin sorted distinct times to window starts: the first of each group, then always the
    first that is at least ``millis`` after the one before. Holds one batch at a time."""

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, deadline = None, 0  # of the last start so far
        for batch in batches:
            if batch.num_rows == 0:
                continue
            times = batch.column(value).to_numpy()
            groups = _starts_of_groups(batch, group_by)
            first = tuple(batch.column(n)[0].as_py() for n in group_by)
            # A row that long after the row before it is a start whatever came before; from
            # one of these to the next there is a stretch, and most have but that one start.
            sure = np.zeros(len(times), dtype=bool)
            sure[1:] = np.diff(times) >= millis
            sure[groups] = True
            sure[0] = first != group
            begins = np.flatnonzero(sure)
            if not sure[0]:  # the last batch's group goes on
                begins = np.concatenate([[0], begins])
            ends = np.concatenate([begins[1:], [len(times)]])
            deadlines = times[begins]
            if not sure[0]:
                deadlines[0] = deadline
            dense = times[ends - 1] >= deadlines + millis
            dense[0] |= not sure[0]
            picked = [begins[~dense]]
            for a, b, deadline in zip(begins[dense], ends[dense], deadlines[dense]):
                at = a + np.searchsorted(times[a:b], deadline)
                while at < b:
                    picked.append([at])
                    deadline = times[at] + millis
                    at += np.searchsorted(times[at:b], deadline)
            if not dense[-1]:
                deadline = deadlines[-1] + millis
            group = tuple(batch.column(n)[len(times) - 1].as_py() for n in group_by)
            yield batch.take(pa.array(np.sort(np.concatenate(picked)).astype("int64")))

    return starts


def _slices(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal ``names``, whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        starts = _starts_of_groups(batch, names).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            part = batch.slice(a, b - a)
            group = tuple(part.column(n)[0].as_py() for n in names)
            if held and group != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            last = group
    if held:
        yield pa.Table.from_batches(held)


def _exits(names: Sequence[str], value: str, step: int) -> Callable:
    """For each value where a chain may enter the slice: the least value its first link beyond the slice can have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches, names):
            times = table.column(value).to_numpy()
            places = np.arange(len(times))
            following = np.searchsorted(times, times + step)
            last = np.where(following < len(times), following, places)
            while True:
                further = last[last]
                if (further == last).all():
                    break
                last = further
            entries = min(len(times), int(np.searchsorted(times, times[0] + step)) + 1)
            bounds = pa.array(times[last[:entries]] + step, pa.int64())
            yield from table.slice(0, entries).append_column(_TO, bounds).combine_chunks().to_batches()

    return run


def _followed(names: Sequence[str], value: str, step: int) -> Callable:
    """The links of the chain in each slice, given where it enters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches, names):
            times = table.column(value).to_numpy()
            following = np.searchsorted(times, times + step).tolist()
            at, picked = int(np.searchsorted(times, table.column(_AT)[0].as_py())), []
            while at < len(times):
                picked.append(at)
                at = following[at]
            kept = [n for n in table.column_names if n not in (_SLICE, _AT)]
            yield from table.select(kept).take(pa.array(picked, pa.int64())).combine_chunks().to_batches()

    return run


def _joined(a: DataFrame, b: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """``a`` and the further columns of ``b``, where ``names`` are equal or both null."""
    other = {n: f"__other_{i}" for i, n in enumerate(names)}
    b = b.withColumnsRenamed(other)
    return a.join(b, [F.col(n).eqNullSafe(F.col(o)) for n, o in other.items()], how).drop(*other.values())


def _slice_of(df: DataFrame, hot: HotKeys) -> DataFrame:
    return _with_slices(df, hot)[0].drop("__hot")


def _jump_table(cut: DataFrame, firsts: DataFrame, group: list[str], value: str, step: int, hot: HotKeys) -> DataFrame:
    """(group, ``__at``, ``__to``): from each value where a chain may enter a slice to where it then enters a later one."""
    place = [*group, _SLICE]
    thin = cut.select(*place, value)
    kinds = T.StructType([*thin.schema.fields, T.StructField(_TO, T.LongType())])
    exits = thin.repartition(*place).sortWithinPartitions(*place, value).mapInArrow(_exits(place, value, step), kinds)
    bounds = _slice_of(exits.select(*group, F.col(value).alias(_AT), F.col(_TO).alias(value)), hot)
    bounds = stored(bounds, "chain-bounds")

    # the first value at or after the bound in the bound's own slice ...
    both = thin.withColumn(_AT, F.lit(None).cast("long")).unionByName(bounds)
    reached = F.min(F.when(F.col(_AT).isNull(), F.col(value)))
    downwards = Window.partitionBy(*place).orderBy(F.col(value).desc()).rangeBetween(Window.unboundedPreceding, 0)
    found = both.withColumn(_TO, reached.over(downwards)).where(F.col(_AT).isNotNull())
    # ... or the first one of the next slice that has any
    every = firsts.unionByName(bounds.select(*place).distinct(), allowMissingColumns=True)
    every = every.groupBy(*place).agg(F.min("__first_value").alias("__first_value"))
    later = Window.partitionBy(*group).orderBy(F.col(_SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    beyond = every.select(*place, F.min("__first_value").over(later).alias("__beyond"))
    landed = _joined(found, beyond, place, "left")
    return landed.select(*group, _AT, F.coalesce(_TO, "__beyond").alias(_TO)).where(F.col(_TO).isNotNull())


def _entries(jumps: DataFrame, firsts: DataFrame, group: list[str]) -> DataFrame:
    """(group, ``__at``): where the chain of each group enters slices, its first value included."""
    longest = firsts.groupBy(*group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    tables = [stored(jumps, "jumps")]
    while 1 << len(tables) < longest:
        one = tables[-1]
        then = one.select(*group, F.col(_AT).alias(_TO), F.col(_TO).alias("__then"))
        tables.append(stored(_joined(one, then, [*group, _TO]).select(*group, _AT, F.col("__then").alias(_TO)), "jumps"))
    entered = firsts.groupBy(*group).agg(F.min("__first_value").alias(_AT))
    for table in reversed(tables):
        onward = _joined(entered, table, [*group, _AT]).select(*group, F.col(_TO).alias(_AT))
        entered = stored(entered.unionByName(onward), "entries")
    return entered


def chain_starts(rows: DataFrame, group: Sequence[str], value: str, step: int, split_rows: int | None = None) -> DataFrame:
    """The rows of ``rows`` whose ``value`` is on the chain of their group.

    ``value`` is a long, not null and distinct within a group; ``step`` is positive. Groups may
    hold nulls, which are equal. Without ``split_rows`` every group is followed in one task, its
    rows passing by a batch at a time; with it, longer groups are cut, and what that takes is
    written to the shared folder.
    """
    group = list(group)
    hot = None
    if split_rows:
        rows = stored(rows, "chain-values")
        hot = find_hot_keys(rows, group, [value], split_rows)

    def in_one_task(df: DataFrame) -> DataFrame:
        placed = df.repartition(*group).sortWithinPartitions(*group, value)
        return placed.mapInArrow(_window_starts(group, step, value), rows.schema)

    if hot is None:
        return in_one_task(rows)
    sliced, _ = _with_slices(rows, hot)
    cut = sliced.where("__hot").drop("__hot")
    place = [*group, _SLICE]
    firsts = stored(cut.groupBy(*place).agg(F.min(value).alias("__first_value")), "chain-slices")
    entered = _entries(_jump_table(cut, firsts, group, value, step, hot), firsts, group)
    entered = _slice_of(entered.withColumnRenamed(_AT, value), hot).withColumnRenamed(value, _AT)
    with_entry = _joined(cut, entered, place)
    placed = with_entry.repartition(*place).sortWithinPartitions(*place, value)
    followed = placed.mapInArrow(_followed(place, value, step), rows.schema)
    return in_one_task(sliced.where(~F.col("__hot")).select(*rows.columns)).unionByName(followed)
