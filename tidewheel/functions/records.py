"""Expressions between JSON text and typed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def location_sentence(who: Column, lat: Column, lon: Column) -> Column:
    """``Patient <who> at location (<lat>, <lon>)``; doubles print as in Java."""
    return F.format_string(
        "Patient %s at location (%s, %s)",
        who.cast("string"),
        lat.cast("string"),
        lon.cast("string"),
    )


def records_to_json(records: Column, fields: Sequence[str] | None = None) -> Column:
    """An array of structs as JSON text, null fields kept; optionally only some ``fields``."""
    if fields is not None:
        records = F.transform(records, lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    return F.to_json(records, {"ignoreNullFields": "false"})
