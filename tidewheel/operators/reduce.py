"""A fold by the user's own function (a, b) -> b over the rows of each key.

The function takes two record batches of equal length and merges them row by row, with Arrow or
numpy functions, so it is called a few times per batch of rows and never for one row. Rows of a
key are merged in pairs, then the results in pairs, and so on, which needs an associative
function. What tasks give is one row per key, merged again after the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.chains import _starts_of_groups
from tidewheel.operators.running import SPLIT_ROWS, _with_slices, find_hot_keys

Merge = Callable[[pa.RecordBatch, pa.RecordBatch], pa.RecordBatch]
#: Partial results of a key meet in so many groups first where order does not matter.
SALTS = 256


def _pairwise(batch: pa.RecordBatch, keys: Sequence[str], values: Sequence[str], merge: Merge) -> pa.RecordBatch:
    """One row per run of equal ``keys``."""
    while True:
        starts = _starts_of_groups(batch, keys)
        sizes = np.diff(np.append(starts, batch.num_rows))
        if not len(sizes) or sizes.max() == 1:
            return batch
        place = np.arange(batch.num_rows) - np.repeat(starts, sizes)
        first = np.flatnonzero(place % 2 == 0)
        has_next = (place[first] + 1) < np.repeat(sizes, sizes)[first]
        left, alone = first[has_next], first[~has_next]
        merged = merge(batch.select(values).take(pa.array(left)), batch.select(values).take(pa.array(left + 1)))
        rows = np.concatenate([left, alone])
        order = pa.array(np.argsort(rows, kind="stable"))
        done = pa.Table.from_batches([merged.select(values), batch.select(values).take(pa.array(alone))]).combine_chunks()
        kept = batch.select([n for n in batch.schema.names if n not in values]).take(pa.array(np.sort(rows)))
        columns = {**dict(zip(kept.schema.names, kept.columns)), **{n: done.column(n).combine_chunks() for n in values}}
        columns = {n: c.take(order) if n in values else c for n, c in columns.items()}
        columns = {n: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for n, c in columns.items()}
        batch = pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], schema=batch.schema)


def _merged(keys: Sequence[str], values: Sequence[str], merge: Merge, sort: bool) -> Callable:
    """Rows that come sorted by ``keys`` to one row per key; with ``sort`` each batch by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if sort:
                batch = pa.Table.from_batches([batch]).sort_by([(k, "ascending") for k in keys]).combine_chunks().to_batches()[0]
                yield _pairwise(batch, keys, values, merge)
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            batch = _pairwise(batch, keys, values, merge)
            yield batch.slice(0, batch.num_rows - 1)
            last = batch.slice(batch.num_rows - 1)
        if last is not None:
            yield last

    return run


def reduce_by_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    merge: Merge,
    order: Sequence[str] = (),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``keys`` and ``values`` merged over the rows of each key; null keys are one key.

    ``merge(a, b)`` gives, for each row, the merge of what came before (``a``) and after (``b``),
    as columns of the same names and types; it must be associative. With ``order`` (total within a
    key) rows are merged in that order, and a key of more than ``split_rows`` rows is cut into
    slices that are merged apart. Without it the function must not mind the order of rows.
    """
    keys, values, order = list(keys), list(values), list(order)
    columns = [*keys, *values]

    def reduced(rows: DataFrame, by: list[str], within: Sequence[str], keep: Sequence[str]) -> DataFrame:
        placed = rows.repartition(*by).sortWithinPartitions(*by, *within).select(*keep)
        return placed.mapInArrow(_merged(by, values, merge, False), placed.schema)

    if not order:
        rows = df.select(*columns)
        partial = rows.mapInArrow(_merged(keys, values, merge, True), rows.schema)
        salted = partial.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        fewer = reduced(salted, [*keys, "__salt"], [], [*columns, "__salt"]).drop("__salt")
        return reduced(fewer, keys, [], columns)
    rows = df.select(*dict.fromkeys([*columns, *order]))
    hot = find_hot_keys(rows, keys, order, split_rows)
    if hot is None:
        return reduced(rows, keys, order, columns)
    sliced, slices = _with_slices(rows, hot)
    parts = reduced(sliced.drop("__hot"), [*keys, *slices], order, [*columns, *slices])
    return reduced(parts, keys, slices, columns)

