"""Text, CSV and parquet, bounded or watched. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE = T.StructType([T.StructField("value", T.StringType())])
CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line. Any path Spark can open works (local, hdfs://, s3a://)."""
    return spark.read.schema(LINE).text(path)


def watch_lines(spark: SparkSession, folder: str, **limits: str | int) -> DataFrame:
    """New text files of ``folder`` as a stream; how often it looks is the query's trigger.

    ``limits`` are reader options such as ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``.
    """
    return spark.readStream.options(**limits).schema(LINE).text(folder)


def _csv_options(mode: str) -> dict[str, str]:
    return {"header": "false", "mode": mode}


def _parsed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """CSV lines as typed columns and the raw line of those that do not parse.

    Goes by text lines because the CSV reader refuses queries on its corrupt-record column
    alone, and those are what a quarantine is for.
    """
    probed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.from_csv("value", probed.simpleString(), options).alias("row")
    return lines.where(F.col("value") != "").select(row).select("row.*")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Headerless CSV as typed rows, columns in file order.

    A field that does not parse becomes null; ``mode='FAILFAST'`` raises instead, and
    ``keep_corrupt`` adds the raw line of a bad row (see :func:`split_corrupt`).
    """
    if keep_corrupt:
        return _parsed_lines(read_lines(spark, path), schema)
    return spark.read.options(**_csv_options(mode)).schema(schema).csv(path)


def watch_csv(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
    **limits: str | int,
) -> DataFrame:
    """:func:`read_csv` for a watched folder."""
    if keep_corrupt:
        return _parsed_lines(watch_lines(spark, folder, **limits), schema)
    return spark.readStream.options(**_csv_options(mode)).options(**limits).schema(schema).csv(folder)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined raw lines) of a frame read with ``keep_corrupt``."""
    bad = F.col(CORRUPT).isNotNull()
    return df.where(~bad).drop(CORRUPT), df.where(bad).select(CORRUPT)


def keyed_lines(df: DataFrame, line: str | Column = "value", separator: str = ":") -> DataFrame:
    """``key<separator>value`` lines as two columns, cut at the first separator only.

    A line without a separator has no key, so it is all value.
    """
    text = F.col(line) if isinstance(line, str) else line
    at = F.instr(text, separator)
    key = F.when(at > 0, F.substring(text, F.lit(1), at - 1))
    value = F.when(at > 0, F.substring(text, at + len(separator), F.length(text))).otherwise(text)
    return df.select(key.alias("key"), value.alias("value"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a data folder (one file or a directory of files)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, **limits: str | int) -> DataFrame:
    """The same table as a stream.

    A streaming file source takes no path to a single file, only folders and patterns,
    hence the pattern that matches just this name.
    """
    schema = read_table(spark, folder, name).schema
    return spark.readStream.options(**limits).schema(schema).parquet(f"{folder}/{name}.parque[t]")
