"""JSON text to typed records, with bad input set apart instead of lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BAD = "_bad_json"


def _with_parsed(df: DataFrame, parsed: Column) -> DataFrame:
    """``df`` and column ``record``. As a plain column the parser would be copied into the
    filter and into each field that is read, and run for each; as the one row of a generator it
    runs once."""
    return df.select("*", F.explode_outer(F.array(parsed)).alias("record"))


def _probed(df: DataFrame, schema: T.StructType, text: str) -> DataFrame:
    probed = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return _with_parsed(df, F.from_json(text, probed, options))


def parse_flagged(df: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """``df`` with the parsed struct in column ``record``, null where ``unread`` is true.

    Text that is not a JSON object of these types is unread. One frame and one parse: write it once,
    divided by ``unread``, where both kinds of rows are wanted.
    """
    parsed = _probed(df, schema, text)
    unread = F.col("record").isNull() | F.col(f"record.{_BAD}").isNotNull()
    record = F.struct(*[F.col(f"record.`{f.name}`").alias(f.name) for f in schema.fields])
    flagged = parsed.withColumn("unread", unread)
    return flagged.withColumn("record", F.when(~F.col("unread"), record))


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    text: str = "value",
    fail_fast: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of :func:`parse_flagged`: ``df`` with column ``record``, and the rows that
    could not be read, as they came.

    Each of the two reads the input. With ``fail_fast`` the job stops at the first such row and the
    quarantine is empty.
    """
    if fail_fast:
        return _with_parsed(df, F.from_json(text, schema, {"mode": "FAILFAST"})), df.where(F.lit(False))
    flagged = parse_flagged(df, schema, text)
    return flagged.where(~F.col("unread")).drop("unread"), flagged.where("unread").select(*df.columns)


def flatten_valid(records: DataFrame, *keep: str) -> DataFrame:
    """The fields of ``record`` as columns, beside the columns named in ``keep``."""
    return records.select(*keep, "record.*")


_LOCATION = T.StructType([T.StructField(n, T.StringType()) for n in ("patientId", "lat", "lon")])


def _coordinates() -> list[Column]:
    return [F.expr(f"try_cast(record.{n} AS double)").alias(n) for n in ("lat", "lon")]


def locations_flagged(df: DataFrame, text: str = "value") -> DataFrame:
    """``{patientId, lat, lon}`` messages as ``df`` with these columns and ``unread``.

    Coordinates are read as text and then cast, so ``"38.5"`` in quotes is a number too; one that is
    missing or no number is null, and so are all three where the message could not be read.
    """
    flagged = parse_flagged(df, _LOCATION, text)
    return flagged.select(*df.columns, "record.patientId", *_coordinates(), "unread")


def parse_locations(df: DataFrame, text: str = "value", fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """The same as (``patientId, lat, lon`` + other columns, quarantine), each of which reads the input."""
    records, bad = parse_json(df, _LOCATION, text, fail_fast)
    others = [c for c in df.columns if c != text]
    return records.select(*others, "record.patientId", *_coordinates()), bad
