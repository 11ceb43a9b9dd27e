"""Running counts of words over lines in order, without a shuffle or a sort of the words.

A count per word by window sends every word through a shuffle and a sort, and words as frequent as
"the" must be cut. Here lines are cut into blocks of their order instead, so no word is too frequent:

1. lines are dealt by block, and each word of a block is counted (one row per block and word);
2. a window per word sums up the counts of earlier blocks: a row per block that the word is in;
3. these totals and the lines are dealt by block once more, and the words of a block are numbered
   in order, each from its total.

A worker holds the different words of a block and some of its lines at a time, however long the block.
The lines are shuffled twice, and so is a row for each block and word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.functions.text import plain_words
from tidewheel.operators.running import in_blocks, running_count
from tidewheel.operators.text import split_words, tokenize

BLOCK_BYTES = 4 << 20
_MOST_TASKS = 20_000  # a task takes several blocks where there are more
_WORDS = 1 << 20  # that a worker numbers at a time


def _runs(batch: pa.RecordBatch, by: Sequence[str]) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Neighbouring rows that agree on ``by``, with their values."""
    if not batch.num_rows:
        return
    marks = np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in by])
    edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        yield tuple(marks[:, start].tolist()), batch.slice(start, end - start)


def _encoded(lines: pa.RecordBatch, plain: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """The words of lines, some at a time: line, position, code, and the word of each code. Codes of raw
    words that differ may have one word, which is empty if nothing is left."""
    words = lines.column(lines.schema.get_field_index("__words"))
    if not plain:
        words = pc.ascii_split_whitespace(words)  # the white space of Java's \s, at either end too
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    flat = words.flatten()
    line = np.repeat(np.arange(len(lengths)), lengths)
    position = (np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
    for at in range(0, len(flat), _WORDS):
        some = flat.slice(at, _WORDS).dictionary_encode()
        named = some.dictionary if plain else pc.replace_substring_regex(some.dictionary, "[^a-z0-9]", "")
        yield line[at : at + _WORDS], position[at : at + _WORDS], some.indices.to_numpy(), named


def _counted(block: Sequence[str], plain: bool):
    """A row for each block and word, from rows sorted by block."""

    def summed(tables: list[pa.Table]) -> list[pa.Table]:
        table = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
        return [table.rename_columns(["word", "n"])]

    def rows(at: tuple[int, ...], tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        if not tables:
            return
        (table,) = summed(tables)
        for batch in table.combine_chunks().to_batches():
            numbers = [pa.array(np.full(batch.num_rows, i), pa.int32()) for i in at]
            yield pa.RecordBatch.from_arrays([*numbers, batch.column("word"), batch.column("n")], [*block, "word", "n"])

    def run(batches):
        here, tables = None, []
        for batch in batches:
            for at, lines in _runs(batch, block):
                if at != here:
                    yield from rows(here, tables)
                    here, tables = at, []
                for _, _, codes, named in _encoded(lines, plain):
                    table = pa.table({"word": named, "n": np.bincount(codes, minlength=len(named)).astype(np.int64)})
                    tables.append(table if plain else table.filter(pc.not_equal(named, "")))
                if len(tables) > 16:
                    tables = summed(tables)
        yield from rows(here, tables)

    return run


def _numbered(block: Sequence[str], order: Sequence[str], name: str, plain: bool):
    """Each word of each line with its count, from rows sorted by block, each with its totals in front."""

    def run(batches):
        words, totals, loaded = [], [], True
        for batch in batches:
            for (*_, is_line), rows in _runs(batch, [*block, "__is_line"]):
                if not is_line:
                    if loaded:
                        words, totals, loaded = [], [], False
                    words.append(rows.column(rows.schema.get_field_index("__word")))
                    totals.append(rows.column(rows.schema.get_field_index("__total")).to_numpy(zero_copy_only=False))
                    continue
                if not loaded:
                    known, so_far, loaded = pa.concat_arrays(words), np.concatenate(totals).astype(np.int64), True
                for line, position, codes, named in _encoded(rows, plain):
                    kept = np.ones(len(named), bool) if plain else pc.not_equal(named, "").to_numpy(zero_copy_only=False)
                    if not kept.any():
                        continue
                    place = pc.fill_null(pc.index_in(named, value_set=known), -1).to_numpy(zero_copy_only=False)
                    if (place[kept] < 0).any():
                        raise ValueError("lines changed while their words were counted")
                    place = np.where(kept, place, -1)[codes]
                    stay = place >= 0
                    place, line, position = place[stay], line[stay], position[stay]
                    by_word = np.argsort(place, kind="stable")
                    sorted_places = place[by_word]
                    first = np.flatnonzero(np.diff(sorted_places, prepend=-1))
                    times = np.diff(first, append=len(sorted_places))
                    count = np.empty(len(place), np.int64)
                    count[by_word] = np.arange(1, len(place) + 1) - np.repeat(first, times)
                    count += so_far[place]
                    so_far[sorted_places[first]] += times
                    ordered = [rows.column(rows.schema.get_field_index(c)).take(pa.array(line)) for c in order]
                    made = [pa.array(position), known.take(pa.array(place)), pa.array(count)]
                    yield pa.RecordBatch.from_arrays([*ordered, *made], [*order, "position", "word", name])

    return run


def running_words(
    lines: DataFrame,
    order: Sequence[str],
    text: str = "value",
    plain: bool = False,
    name: str = "cnt",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each word of each line, as :func:`tokenize` or (``plain``) :func:`split_words` has them, with ``order``,
    ``position`` and how often the word has come up to there.

    ``order`` must be total, and ``lines`` must give the same rows whenever they are computed.
    """
    order = list(order)
    if clash := {"word", "position"} & set(order):
        raise ValueError(f"columns to keep have names of new ones: {sorted(clash)}")
    lines = lines.select(*order, F.col(text).alias("__text"))
    size = F.coalesce(F.octet_length("__text"), F.lit(0)) + 1
    cut = in_blocks(lines, order, size, block_bytes)
    if cut is None:
        words = (split_words if plain else tokenize)(lines, "__text", order, "position")
        return running_count(words, ["word"], [*order, "position"], name)
    blocks, block, n = cut
    task = F.pmod(sum(F.col(c) for c in block), F.lit(min(n, _MOST_TASKS))).cast("int")

    def dealt(rows: DataFrame, *then: str) -> DataFrame:
        by_block = rows.repartitionById(min(n, _MOST_TASKS), task).sortWithinPartitions(*block, *then)
        # no null lists: Spark asks for the size of its batch at each row, and that takes Arrow a pass over them
        split = F.coalesce(plain_words(F.col("__text")), F.array().cast("array<string>"))
        words = split if plain else F.coalesce(F.lower("__text"), F.lit(""))
        return by_block.select(*[c for c in rows.columns if c != "__text"], words.alias("__words"))

    numbers = [T.StructField(c, T.IntegerType()) for c in block]
    word, count = T.StructField("word", T.StringType()), T.StructField("n", T.LongType())
    counted = dealt(blocks.select(*block, "__text")).mapInArrow(_counted(block, plain), T.StructType([*numbers, word, count]))
    earlier = Window.partitionBy("word").orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__total")
    totals = counted.select(*block, F.lit(0).alias("__is_line"), F.col("word").alias("__word"), total)
    rows = blocks.withColumn("__is_line", F.lit(1)).unionByName(totals, allowMissingColumns=True)

    kept = [T.StructField(c, lines.schema[c].dataType) for c in order]
    made = [T.StructField("position", T.IntegerType()), word, T.StructField(name, T.LongType())]
    return dealt(rows, "__is_line", *order).mapInArrow(_numbered(block, order, name, plain), T.StructType([*kept, *made]))
