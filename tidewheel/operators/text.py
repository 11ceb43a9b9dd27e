"""Line and word operators, for bounded and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.text import has_letters, only_letters, plain_words, raw_words


def _exploded(df: DataFrame, words: Column, keep: Sequence[str], position: str | None) -> DataFrame:
    if clash := {"word", position} & set(keep):
        raise ValueError(f"columns to keep have names of new ones: {sorted(clash)}")
    made = F.posexplode(words).alias(position, "word") if position else F.explode(words).alias("word")
    return df.select(*keep, made)


def tokenize(df: DataFrame, text: str = "value", keep: Sequence[str] = (), position: str | None = None) -> DataFrame:
    """Normalised words of each line, one row ``word`` each: lower case, ASCII letters and digits
    only, what else there is deleted. Words of which nothing is left are left out.

    ``keep`` names columns of the line to go along, and ``position`` a column for the word's place
    in the line, from 0, words left out counted: together they say in which order words came.
    """
    words = _exploded(df, raw_words(F.col(text)), keep, position)
    # the filter looks at the raw word, so that the replacement runs once, on words that stay
    others = [c for c in words.columns if c != "word"]
    return words.where(has_letters(F.col("word"))).select(*others, only_letters(F.col("word")).alias("word"))


def split_words(df: DataFrame, text: str = "value", keep: Sequence[str] = (), position: str | None = None) -> DataFrame:
    """White-space separated words as they stand, one row ``word`` each; else as :func:`tokenize`."""
    return _exploded(df, plain_words(F.col(text)), keep, position)


def upper_lines(df: DataFrame, text: str = "value") -> DataFrame:
    return df.withColumn(text, F.upper(text))


def lines_starting_with(df: DataFrame, prefix: str, text: str = "value") -> DataFrame:
    """Rows whose text starts with ``prefix`` (case-sensitive; reaches the parquet scan)."""
    return df.where(F.col(text).startswith(prefix))
