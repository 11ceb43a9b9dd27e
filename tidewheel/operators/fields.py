"""Lines with quoted fields, as a table function over Arrow batches.

Whether a separator counts depends on the quotes before it in its line, a state that a split or an
``explode`` does not have. It is worked out for all lines of a batch at once, on their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR, QUOTE = ":", '"'


def split_quoted(lines: pa.Array, separator: str = SEPARATOR) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(line, position in it, field) of all fields, lines and fields in order. A null line has none.

    Separators within quotes belong to the field. Quotes around a whole field go, and two quotes in
    such a field are one. A quote that is not closed holds to the end of its line.
    """
    known = np.flatnonzero(pc.is_valid(lines).to_numpy(zero_copy_only=False))
    lines = lines.take(pa.array(known, pa.int64())).cast(pa.large_binary())
    if isinstance(lines, pa.ChunkedArray):
        lines = lines.combine_chunks()
    n = len(lines)
    _, bounds, body = lines.buffers()
    bounds = np.frombuffer(bounds, np.int64)[lines.offset : lines.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]] if body is not None and body.size else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    quotes = np.concatenate(([0], np.cumsum(data == ord(QUOTE))))
    at = np.flatnonzero(data == ord(separator))
    line = np.searchsorted(bounds, at, "right") - 1
    outside = (quotes[at] - quotes[bounds[line]]) % 2 == 0
    at, line = at[outside], line[outside]

    every = np.arange(n)
    of = np.concatenate((every, line))
    starts = np.concatenate((bounds[:-1], at + 1))
    order = np.lexsort((starts, of))
    of, starts = of[order], starts[order]
    ends = np.concatenate((bounds[1:], at))
    ends = ends[np.lexsort((ends, np.concatenate((every, line))))]
    quoted = ends - starts >= 2
    quoted[quoted] = (data[starts[quoted]] == ord(QUOTE)) & (data[ends[quoted] - 1] == ord(QUOTE))
    starts, ends = starts + quoted, ends - quoted
    sizes = ends - starts
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    picked = np.repeat(starts - cuts[:-1], sizes) + np.arange(cuts[-1])
    fields = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data[picked].tobytes()))
    fields = pc.if_else(pa.array(quoted), pc.replace_substring(fields, QUOTE * 2, QUOTE), fields)
    position = np.arange(len(of)) - np.searchsorted(of, of)
    return known[of], position, fields.cast(pa.string())


def quoted_fields(lines: DataFrame, line: str, keep: str, separator: str = SEPARATOR) -> DataFrame:
    """``keep`` (a long), ``position`` (from 0) and ``field`` of every field of column ``line``."""
    if len(separator.encode()) != 1 or separator == QUOTE:
        raise ValueError("the separator is one ASCII character other than the quote")

    class Fields:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            of, position, field = split_quoted(rows.column("line"), separator)
            ids = rows.column("id").take(pa.array(of, pa.int64()))
            yield pa.table({"id": ids, "position": pa.array(position, pa.int32()), "field": field})

    function = F.arrow_udtf(Fields, returnType="id long, position int, field string")
    rows = lines.select(F.col(keep).cast("long").alias("id"), F.col(line).alias("line"))
    return function(rows.asTable()).withColumnRenamed("id", keep)
