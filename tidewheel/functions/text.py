"""String and number expressions used by the row maps and the tokenizers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def raw_words(text: Column) -> Column:
    """Lower-case text cut at white space, as an array; may hold empty strings."""
    return F.split(F.lower(text), r"\s+")


def has_letters(word: Column) -> Column:
    """Whether a raw word has anything left after :func:`only_letters`."""
    return word.rlike("[a-z0-9]")


def only_letters(word: Column) -> Column:
    """A raw word without everything but ASCII letters and digits: ``don't`` gives ``dont``.

    Deleting inside words leaves white space alone, so it may follow the split. That is much
    cheaper than to rewrite whole texts first.
    """
    return F.regexp_replace(word, "[^a-z0-9]", "")


def plain_words(text: Column) -> Column:
    """Split on white space and change nothing else, by the rules of Java's ``split``.

    Trailing empty words are dropped and a leading one is kept; an empty line is one empty
    word, and a line of nothing but white space has none.
    """
    blank = text.rlike(r"^\s+$")
    words = F.split(text, r"\s+")  # at most one empty word comes last
    cut = F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), F.slice(words, 1, F.size(words) - 1)).otherwise(words)
    return F.when(blank, F.array().cast("array<string>")).otherwise(cut)


def show_upper(text: Column) -> Column:
    """``[v] => V``."""
    return F.format_string("[%s] => %s", text, F.upper(text))


def with_prefix(prefix: str, value: Column) -> Column:
    """``value`` as text behind a constant."""
    return F.concat(F.lit(prefix), value.cast("string"))


def fold_sequence(n: Column, half: int, step: int = 1000) -> Column:
    """Number the first ``half`` values from 1 and the rest from 1 again, times ``step``.

    Taken as event times, the second half goes back to the start: out-of-order input.
    """
    return F.when(n <= half, n * step).otherwise((n - half) * step)
