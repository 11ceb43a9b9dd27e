"""Rows in a form that survives the way through pandas and the state store unchanged.

On that way integers with a null among them turn into floats, a null key differs from itself
and times shift with the zone. So only plain columns go: the key and the row's fields as JSON
text, made and read back by Spark's own functions, and integers to sort by.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Times to the microsecond, in Spark's pattern letters.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
KEY, BODY = "key", "body"


def _sortable(df: DataFrame, name: str) -> Column:
    is_time = isinstance(df.schema[name].dataType, T.TimestampType)
    return F.unix_micros(name) if is_time else F.col(name)


def pack(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], **extra: Column
) -> tuple[DataFrame, list[str]]:
    """(``key, body``, order columns and ``extra``; names of the order columns)."""
    names = [f"order{i}" for i in range(len(order))]
    packed = df.select(
        F.to_json(F.struct(*keys), _JSON).alias(KEY),
        F.to_json(F.struct(*fields), _JSON).alias(BODY),
        *[_sortable(df, c).alias(n) for c, n in zip(order, names)],
        *[c.alias(n) for n, c in extra.items()],
    )
    return packed, names


def unpack(
    packed: DataFrame, source: DataFrame, keys: Sequence[str], labels: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Typed ``keys`` (those not among the fields), then ``labels``, then ``fields``."""

    def read(column: str, names: Sequence[str]) -> Column:
        # what does not come back as it went is an error, not a null
        return F.from_json(column, T.StructType([source.schema[n] for n in names]), {**_JSON, "mode": "FAILFAST"}).alias(column)

    parsed = packed.select(read(KEY, keys), *labels, read(BODY, fields))
    alone = [F.col(f"{KEY}.`{k}`").alias(k) for k in keys if k not in fields]
    return parsed.select(*alone, *labels, f"{BODY}.*")


def in_order(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    """A key's rows of one micro-batch, sorted; a shuffle does not keep arrival order."""
    pieces = list(rows)
    pdf = pieces[0] if len(pieces) == 1 else pd.concat(pieces, ignore_index=True)
    columns = [pdf[c].to_numpy() for c in order]
    if any(c.dtype.kind == "O" or (c.dtype.kind == "f" and np.isnan(c).any()) for c in columns):
        return pdf.sort_values(list(order), kind="stable", na_position="first")
    return pdf.iloc[np.lexsort(columns[::-1])]
