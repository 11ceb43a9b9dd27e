"""Running totals per key, in order, for keys of any size.

A window over ``PARTITION BY key ORDER BY ...`` sorts each key in one task. That is right
for ordinary keys and hopeless for one that holds a third of a large table, so rows of such
a key are cut into slices of its order:

1. rows are counted per key (combined before the shuffle); keys of more than ``split_rows`` are hot;
2. a sample of the hot rows, taken by a hash of key and order, gives slice borders, some eight per
   ``split_rows`` rows. If many rows share one value, that value is cut by the next order column;
   a text is cut by four bytes after another;
3. the totals of each (key, slice) are summed up over the earlier slices, and these sums
   join the data as one extra leading row per slice, so a plain window by (key, slice) goes
   on from the right value.

The sample only decides where to cut. The result is exact for any choice, and with no hot key
there is just the plain window. The data are shuffled once either way. What the client holds and
the plan carries is a hash code per hot key and eight borders per ``split_rows`` hot rows: for
10**12 rows at most 200,000 codes and 1.6 million borders, some 15 MB; to find them the client
reads one number per border and level (13 levels for a text), at most 170 MB for that many rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions.numbers import micros

SPLIT_ROWS = 5_000_000
_BORDERS = 8  # to expect per split_rows rows, so that a slice seldom gets longer than that
_EXACT_DOUBLE = float(2**53)
# Texts are cut by so many chunks of four bytes; those that agree on all of them and go on stay together.
_CHUNKS = 12
_CHUNK_VALUES = float(2**33)

_OPS = {"sum": F.sum, "max": F.max}


@dataclass(frozen=True)
class Fold:
    """``op`` (``sum`` or ``max``) of ``value`` over a key's rows up to this one.

    ``inclusive=False`` leaves the row itself out; ``whole`` takes all rows of the key. An
    empty sum is 0 and an empty maximum null.
    """

    name: str
    value: Column
    op: str = "sum"
    inclusive: bool = True
    whole: bool = False


@dataclass(frozen=True)
class HotKeys:
    """Hash codes of the keys to cut, and slice borders per level of the order columns.

    Good for frames with more grouping columns too: a part of a key is cut where its key is.
    """

    keys: list[str]
    order: list[str]
    hashes: list[int]
    borders: list[tuple[list[float], list[float]]]  # per level: splits, values to cut further

    def mark(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with a boolean column that says whether the row's key is hot."""
        code = f"{name}_code"
        codes = df.sparkSession.createDataFrame([(h,) for h in self.hashes], f"{code} long")
        marked = df.join(F.broadcast(codes), _key_hash(self.keys) == F.col(code), "left")
        return marked.withColumn(name, F.col(code).isNotNull()).drop(code)


@dataclass(frozen=True)
class _Level:
    """A number that goes up with the order column among rows that are equal on the levels before.

    ``value`` is never null. A value below ``exact`` in size stands for one value of the level only.
    ``whole``: it is a whole number below 2**33, so that it can be cut apart for each earlier slice.
    """

    value: Column
    exact: float = _EXACT_DOUBLE
    whole: bool = False
    nulls: bool = True  # minus infinity means null and nothing else

    def within(self, slice_before: Column | np.ndarray, value: Column | np.ndarray) -> Column | np.ndarray:
        return slice_before * _CHUNK_VALUES + value if self.whole else value

    def stands_for_one(self, value: np.ndarray) -> np.ndarray:
        return (np.abs(value) < self.exact) | (np.isneginf(value) & self.nulls)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _levels(name: str, kind: T.DataType) -> list[_Level]:
    """The order column as levels, nulls first; none if it can't be cut by."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.BinaryType, T.StringType)) and kind in (T.BinaryType(), T.StringType()):
        digits = F.rpad(F.hex(F.substring(c, 1, 4 * _CHUNKS)), 8 * _CHUNKS, "0")  # by bytes, as texts are sorted
        chunks = [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("double") + 1 for i in range(_CHUNKS)]
        length = F.least(F.octet_length(c), F.lit(4 * _CHUNKS + 1)).cast("double")
        whole = [_Level(F.coalesce(x, F.lit(0.0)), whole=True) for x in chunks]
        return [*whole, _Level(F.coalesce(length, F.lit(0.0)), exact=4 * _CHUNKS + 1)]
    x = _number(c, name, kind)
    if x is None:
        return []
    inexact = isinstance(kind, T.DecimalType)
    is_float = isinstance(kind, (T.FloatType, T.DoubleType))
    return [_Level(F.coalesce(x, F.lit(-math.inf)), 0.0 if inexact else _EXACT_DOUBLE, nulls=not is_float)]


def _number(c: Column, name: str, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    time = micros(name, kind)
    return None if time is None else time.cast("double")


def _all_levels(df: DataFrame, order: Sequence[str]) -> list[_Level]:
    """The levels of the order columns, up to the first column that can't be cut by."""
    out: list[_Level] = []
    for name in order:
        levels = _levels(name, df.schema[name].dataType)
        if not levels:
            break
        out += levels
    return out


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split_rows: int = SPLIT_ROWS,
    counts: DataFrame | None = None,
) -> HotKeys | None:
    """Keys of more than ``split_rows`` rows and where to cut them; None if there are none.

    Runs one count per key (spared if ``counts`` has each key with its number of rows ``n``) and,
    only if a key is hot, takes a sample of the rows of the hot keys.
    """
    if counts is None:
        counted = df.select(_key_hash(keys).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    else:
        counted = counts.select(_key_hash(keys).alias("h"), "n")
    hashes = [r["h"] for r in counted.where(F.col("n") > split_rows).select("h").collect()]
    levels = _all_levels(df, order)
    if not hashes or not levels:
        return None

    every = max(1, split_rows // _BORDERS)
    hot = HotKeys(list(keys), list(order), hashes, [])
    drawn = df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0)
    sample = hot.mark(drawn, "__hot").where("__hot").select(*[x.value.alias(f"x{i}") for i, x in enumerate(levels)])
    hot.borders.extend(_borders(sample.toPandas().to_numpy(dtype=float), levels))
    return hot if hot.borders else None


def _borders(drawn_levels: np.ndarray, levels: Sequence[_Level]) -> list[tuple[list[float], list[float]]]:
    """Slice borders per level at the rows drawn, as :class:`HotKeys` has them."""
    out: list[tuple[list[float], list[float]]] = []
    before = np.zeros(len(drawn_levels))
    for i, level in enumerate(levels):
        x = level.within(before, drawn_levels[:, i])
        values, times = np.unique(x[~np.isnan(x)], return_counts=True)
        # a value with two borders or more gets a slice to itself and is cut by the next level
        # (if it stands for one value of the column only)
        crowded = values[(times > 1) & level.stands_for_one(values)]
        crowded = crowded if i + 1 < len(levels) else crowded[:0]
        cuts = np.unique(np.concatenate([values, np.nextafter(crowded, np.inf)]))
        splits = cuts[np.isfinite(cuts)]
        if not len(splits) and not len(crowded):
            break
        out.append((splits.tolist(), crowded.tolist()))
        before = np.searchsorted(splits, x, side="right").astype(float)
        stay = np.isin(x, crowded)
        if not stay.any():
            break
        drawn_levels, before = drawn_levels[stay], before[stay]
    return out


def in_blocks(df: DataFrame, order: Sequence[str], size: Column, block: int) -> tuple[DataFrame, list[str], int] | None:
    """``df`` with columns that number blocks of its order, their names, and about how many blocks there are.

    A block holds rows of some ``block`` in ``size`` (a whole number over 0) together; the blocks follow
    each other as their numbers do. They are cut as a hot key is: a sample says where, any choice is right.
    None if the order's first column can't be cut by.
    """
    levels = _all_levels(df, order)
    if not levels:
        return None
    drawn = df.where(F.pmod(F.xxhash64(*order), F.lit(max(1, block // _BORDERS))) < size)
    sample = drawn.select(*[x.value.alias(f"x{i}") for i, x in enumerate(levels)]).toPandas().to_numpy(dtype=float)
    in_order = sample[np.lexsort(sample.T[::-1])]
    borders = _borders(in_order[_BORDERS::_BORDERS], levels)  # every eighth: blocks get more even
    every = df.withColumn("__all", F.lit(0))
    code = every.select(_key_hash(["__all"]).alias("h")).limit(1).collect()
    hot = HotKeys(["__all"], list(order), [r["h"] for r in code], borders)
    if not borders or not code:
        return df.withColumn("__slice0", F.lit(0)), ["__slice0"], 1
    cut, names = _with_slices(every, hot)
    return cut.drop("__all", "__hot"), names, 1 + sum(len(splits) for splits, _ in borders)


def _with_slices(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, list[str]]:
    """``df`` with a column ``__hot`` and one slice column per level. Rows of ordinary keys are all in one slice."""
    df = hot.mark(df, "__hot")
    to_cut, before, names = F.col("__hot"), F.lit(0.0), []
    for i, (level, (splits, crowded)) in enumerate(zip(_all_levels(df, hot.order), hot.borders)):
        source, name = f"__x{i}", f"__slice{i}"
        df = df.withColumn(source, F.when(to_cut, level.within(before, level.value)))
        df = Bucketizer(
            splits=[-math.inf, *(splits or [0.0]), math.inf], inputCol=source, outputCol=name, handleInvalid="keep"
        ).transform(df)
        df = df.withColumn(name, F.when(F.col(source).isNotNull(), F.col(name).cast("int")).otherwise(0))
        df = df.withColumn("__cut", to_cut & F.col(source).isin(crowded) if crowded else F.lit(False))
        df = df.drop(source)
        to_cut, before = F.col("__cut"), F.col(name).cast("double")
        names.append(name)
    return df.drop("__cut"), names


def _fold(fold: Fold, over: Column | None = None, value: Column | None = None) -> Column:
    total = _OPS[fold.op](fold.value if value is None else value)
    total = total if over is None else total.over(over)
    return F.coalesce(total, F.lit(0)) if fold.op == "sum" else total


def running_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Sequence[Fold],
    hot: HotKeys | None,
    partitions: int | None = None,
) -> DataFrame:
    """``df`` and one column per fold.

    ``order`` must be total within a key (end it with a unique column), and ``df`` must give the
    same rows whenever it is computed. ``hot`` is what :func:`find_hot_keys` said of ``df``, or of
    a frame that ``df`` was made from with the same rows and order, by some of the keys. ``partitions``
    is the number of tasks that rows are dealt to (default: the session's number of shuffle partitions).
    """
    keys, order = list(keys), list(order)

    def frame(window, fold):
        return window.rowsBetween(Window.unboundedPreceding, 0 if fold.inclusive else -1)

    if hot is None:
        in_order, all_rows = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
        dealt = df.repartition(partitions, *keys) if partitions else df
        return dealt.select(
            "*", *[_fold(f, all_rows if f.whole else frame(in_order, f)).alias(f.name) for f in folds]
        )

    value = {f.name: f"__v_{f.name}" for f in folds}
    sliced, slices = _with_slices(df.select("*", *[f.value.alias(value[f.name]) for f in folds]), hot)

    # Totals of the earlier slices (for ``whole``: of all slices), one row per (key, slice) of a hot key.
    totals = (
        sliced.where("__hot")
        .groupBy(*keys, *slices)
        .agg(*[_OPS[f.op](value[f.name]).alias(value[f.name]) for f in folds])
    )
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        *slices,
        F.lit(0).alias("__is_row"),
        *[
            _OPS[f.op](value[f.name]).over(per_key if f.whole else earlier).alias(value[f.name])
            for f in folds
        ],
    )
    rows = sliced.drop("__hot").withColumn("__is_row", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    if partitions:
        rows = rows.repartition(partitions, *keys, *slices)

    part = Window.partitionBy(*keys, *slices)
    in_order = part.orderBy("__is_row", *order)

    def result(f: Fold) -> Column:
        if not f.whole:
            return _fold(f, frame(in_order, f), F.col(value[f.name]))
        # hot: the leading row holds the key's total; ordinary: the one slice is the whole key
        carried_total = F.max(F.when(F.col("__is_row") == 0, F.col(value[f.name]))).over(part)
        is_hot = F.min("__is_row").over(part) == 0
        total = F.when(is_hot, carried_total).otherwise(_OPS[f.op](value[f.name]).over(part))
        return F.coalesce(total, F.lit(0)) if f.op == "sum" else total

    out = rows.select("*", *[result(f).alias(f.name) for f in folds]).where(F.col("__is_row") == 1)
    return out.select(*df.columns, *[f.name for f in folds])


def running_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "cnt",
    split_rows: int = SPLIT_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``df`` with the number of rows of the key so far: the total as of each record. ``counts`` is
    what :func:`find_hot_keys` takes."""
    hot = find_hot_keys(df, keys, order, split_rows, counts)
    return running_fold(df, keys, order, [Fold(name, F.lit(1).cast("long"))], hot)
