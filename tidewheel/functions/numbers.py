"""Times and pairs of columns as whole numbers."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FAR = 1_300_000_000_000_000_000  # microseconds from 1970, about 41,000 years
_STEP = Decimal(1 << 65)  # more than there are values of a long and null


def micros(name: str, kind: T.DataType) -> Column | None:
    """A time column in microseconds from 1970, None for other types."""
    c = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):  # by its fields: a cast would go through a time zone
        clock = F.hour(c) * 3600 + F.minute(c) * 60
        rest = (F.expr(f"extract(SECOND FROM `{name}`)") * 1_000_000).cast("long")
        return (F.unix_date(c.cast("date")).cast("long") * 86400 + clock) * 1_000_000 + rest
    return None


def as_one_number(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """A time and a whole number as one decimal that sorts as the two do, nulls first.

    None for other columns. Spark aggregates by hash where it compares numbers, and sorts
    first where it compares structs. Times more than 41,000 years off sort as equal.
    """
    if len(columns) != 2:
        return None
    time = micros(columns[0], df.schema[columns[0]].dataType)
    if time is None or not isinstance(df.schema[columns[1]].dataType, T.IntegralType):
        return None
    near = F.greatest(F.least(time, F.lit(_FAR)), F.lit(-_FAR))
    time = F.when(time.isNull(), F.lit(-_FAR - 1)).otherwise(near)  # greatest and least pass over nulls
    number = F.coalesce(F.col(f"`{columns[1]}`").cast("decimal(20,0)"), F.lit(Decimal(-(1 << 63) - 1)))
    return time.cast("decimal(19,0)") * F.lit(_STEP) + number
