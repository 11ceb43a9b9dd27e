"""Substring dedup by level-wise doubling: 5-word windows, of the repeated ones 10-word windows, then 20-word windows.

All that may be removed is covered by windows of ``length`` (20) words, which are named by their text and first
word. A window can only repeat if each shorter window in it does. One shorter window speaks for it: the one with
the least hash, so equal windows choose the same. Neighbouring windows mostly share that choice and travel as one
run, which is why a level costs an eighth of a row for each word, not one.

1. Level 5: the runs of all texts; those stay whose 5-word window occurs in two runs.
2. Level 10: only windows left are read again and grouped by their 10-word window, with a hash of all words of the
   run; those stay whose 10-word window occurs in two runs. A run whose words are those of an earlier run is wholly repeated. Of equal runs the first goes on, if other
   runs have its 10-word window too; all else is unique.
3. Level 20: the windows of those runs, one by one; any but the first of equal ones is repeated.

The tables of counts are joined, never gathered: a passage that half of all texts hold is one row for each task that
reads texts. Level 1 reads texts as they are and writes the lists of its runs; then texts are shuffled once by document, and
that shuffle serves the three reads of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.hashing import Chunk, chunks
from tidewheel.llm.tables import stored

#: Windows of so many words are removed; the levels before it are a half and a quarter as long.
LENGTH = 20
#: ``at`` is the text's mark above these bits and a word's place in the text below them.
PLACE_BITS = 32
_PLACE = (1 << PLACE_BITS) - 1
#: A run in a text's list is its place above these bits and its number of windows below them.
RUN_BITS = 16
LONGEST = 1 << 15
#: Stands for a null doc_id: first in order.
NO_ID = -(1 << 63)


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` neighbours is, the first of equal ones."""
    at, done = np.arange(len(grams)), 1
    while done < width:
        step = min(done, width - done)
        left, right = at[:-step], at[step:]
        at = np.where(grams[right] < grams[left], right, left)
        done += step
    return at


def _windows(chunk: Chunk, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first word of each window of the chunk, and the place and hash of its least ``k``-word window."""
    n = len(chunk.words)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.arange(k, n + 1)
    grams = chunk.runs(ends - k, ends)
    at = _least(grams, length - k + 1)
    starts = np.flatnonzero(np.arange(len(at)) + length <= chunk.last[: len(at)])
    return starts, at[starts], grams[at[starts]]


def _neighbours(starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs of neighbouring windows that chose the same place; no two windows of a run are equal."""
    if not len(starts):
        return starts, starts
    first = np.flatnonzero(np.concatenate(([True], (np.diff(starts) != 1) | (at[1:] != at[:-1]))))
    return first, np.concatenate((first[1:], [len(starts)])) - 1


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the first with their keys, and how many rows have the keys of each."""
    n = len(keys[0])
    order = np.lexsort((np.arange(n), *keys[::-1]))
    new = np.ones(n, bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    first, count = np.zeros(n, bool), np.zeros(n, np.int64)
    first[order] = new
    count[order] = np.bincount(group, minlength=1)[group] if n else group
    return first, count


def _stretches(starts: np.ndarray, n: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """The first of each stretch of runs that follow each other with equal keys, for as many windows as a run may have."""
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + n[:-1]) | np.any([k[1:] != k[:-1] for k in keys], axis=0)
    head = np.maximum.accumulate(np.where(new, np.arange(len(starts)), 0))
    long = (starts - starts[head]) // LONGEST
    new[1:] |= long[1:] != long[:-1]
    return np.flatnonzero(new)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _of_rows(batch: pa.RecordBatch, chunk: Chunk, index: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """doc_id, and ``at`` of the words ``index``."""
    row = np.searchsorted(chunk.bounds, index, "right") - 1
    marks = batch.column("mark").to_numpy(zero_copy_only=False)[chunk.first + row].astype(np.int64)
    return batch.column("doc_id").take(pa.array(chunk.first + row)), (marks << PLACE_BITS) | (index - chunk.bounds[row])


def _listed(batch: pa.RecordBatch, chunk: Chunk, name: str) -> np.ndarray:
    """Which words of the chunk start windows of the runs listed in the column ``name``."""
    lists = batch.column(name).slice(chunk.first, chunk.rows)
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    runs = lists.flatten()
    change = np.zeros(len(chunk.words) + 1, np.int64)
    if len(runs):
        runs = runs.to_numpy(zero_copy_only=False).astype(np.int64)
        start = (runs >> RUN_BITS) + np.repeat(chunk.bounds[:-1], sizes)
        np.add.at(change, start, 1)
        np.add.at(change, start + (runs & ((1 << RUN_BITS) - 1)), -1)
    return np.cumsum(change)[:-1] > 0


def _first_level(length: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                starts, place, value = _windows(chunk, length, k)
                first, last = _neighbours(starts, place)
                starts, value, n = starts[first], value[first], last - first + 1
                # a text that says one thing over and over is one row
                head = _stretches(starts, n, value, chunk.last[starts])
                runs = np.diff(np.concatenate((head, [len(starts)])))
                n = np.add.reduceat(n, head) if len(head) else n
                ids, at = _of_rows(batch, chunk, starts[head])
                columns = [_signed(value[head]), at, n.astype(np.int32), runs]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], ["doc_id", "value", "at", "n", "runs_held"])

    return run


def _told(batch: pa.RecordBatch, chunk: Chunk, starts: np.ndarray, value: np.ndarray, words: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The runs of a chunk; one that its own text has already held is known to be repeated and is only told as such."""
    row = np.searchsorted(chunk.bounds, starts, "right") - 1
    first, count = _firsts(row, value, words)
    again = np.flatnonzero(~first)
    head = again[_stretches(starts[again], n[again], row[again])] if len(again) else again
    total = np.concatenate(([0], np.cumsum(np.where(first, 0, n))))
    stop = np.concatenate((head[1:], [len(starts)])) if len(head) else head
    rows = np.concatenate((np.flatnonzero(first), head))
    sizes = np.concatenate((n[first], total[stop] - total[head]))
    sure = np.arange(len(rows)) >= first.sum()
    ids, at = _of_rows(batch, chunk, starts[rows])
    columns = [_signed(value[rows]), _signed(words[rows]), at, sizes.astype(np.int32), np.where(sure, 0, count[rows]), sure]
    yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], ["doc_id", "value", "words", "at", "n", "runs_held", "sure"])


def _second_level(length: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                starts, place, value = _windows(chunk, length, k)
                left = _listed(batch, chunk, "runs")[starts]
                starts, place, value = starts[left], place[left], value[left]
                first, last = _neighbours(starts, place)
                words = chunk.runs(starts[first], starts[last] + length)
                yield from _told(batch, chunk, starts[first], value[first], words, last - first + 1)

    return run


def _last_level(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                starts, _, value = _windows(chunk, length, length // 2)
                left = _listed(batch, chunk, "runs")[starts]
                starts, value = starts[left], value[left]
                yield from _told(batch, chunk, starts, value, chunk.runs(starts, starts + length), np.ones(len(starts), np.int64))

    return run


def _cut(length: int, digest: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                repeated = _listed(batch, chunk, "runs").astype(np.int64)
                change = np.zeros(len(repeated) + length, np.int64)
                change[: len(repeated)] += repeated
                change[length:] -= repeated
                gone = np.cumsum(change)[: len(repeated)] > 0
                total = np.concatenate(([0], np.cumsum(gone)))[chunk.bounds]
                n_words, n_removed = np.diff(chunk.bounds), np.diff(total)
                kept = []
                for i, text in enumerate(batch.column("text").slice(chunk.first, chunk.rows).to_pylist()):
                    if text is None or not n_removed[i]:
                        kept.append(text)
                    else:
                        drop = gone[chunk.bounds[i] : chunk.bounds[i + 1]].tolist()
                        kept.append(b" ".join(w for w, d in zip(text.encode().split(), drop, strict=True) if not d).decode())
                if digest:
                    kept = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in kept]
                rest = [batch.column(c).slice(chunk.first, chunk.rows) for c in batch.schema.names if c not in ("text", "mark", "runs")]
                names = [c for c in batch.schema.names if c not in ("text", "mark", "runs")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(n_words), pa.array(n_removed), pa.array(kept, pa.string())], [*names, "n_words", "n_removed", "kept"])

    return run


def _repeated(found: DataFrame) -> DataFrame:
    """The rows whose value more than one run has."""
    twice = found.groupBy("value").agg(F.sum("runs_held").alias("c")).where("c > 1").select("value")
    return found.join(twice, "value", "left_semi")


def _by_text(runs: DataFrame) -> DataFrame:
    """One row for each text with the list of its runs, which is as long as the text at most."""
    mark = F.shiftright("at", PLACE_BITS).alias("mark")
    run = F.shiftleft(F.col("at").bitwiseAND(_PLACE), RUN_BITS) + F.col("n")
    return runs.select("doc_id", mark, run.alias("run")).groupBy("doc_id", "mark").agg(F.collect_list("run").alias("runs"))


def remove_repeats(documents: DataFrame, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """Remove every word covered by a ``length``-word window that also starts earlier.

    Windows are runs of ``length`` words (split at the blanks 0x20, 0x09 to 0x0D, otherwise unchanged) of one text;
    earlier means a smaller doc_id or, in one text, an earlier word. Judged on the input as it is. ``documents`` has
    ``doc_id`` and ``text``; other columns are carried along, but for those that have a name of the result. Adds n_words, n_removed (long) and
    ``kept``: the text, unchanged where nothing was removed and else the words left, joined by one space; with
    ``digest`` the SHA-256 of the words left instead, and then no other columns than doc_id are carried.

    Null texts and texts without words have 0 words and stay as they are; so do texts below ``length`` words. Null
    doc_ids come first (doc_id is a long above the least one). Rows that repeat a doc_id with the same text are one document (each is answered alike); with
    other texts they are different documents, in order of a hash of the text. An empty table gives an empty table.
    """
    quarter, half = length // 4, length // 2
    if quarter < 1:
        raise ValueError("length is 4 at least")
    others = [] if digest else [c for c in documents.columns if c not in ("doc_id", "text", "n_words", "n_removed", "kept")]
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        "text",
        F.xxhash64("text").bitwiseAND((1 << 31) - 1).alias("mark"),
        *([F.struct(*[documents[c] for c in others]).alias("carried")] if others else []),
    )
    doc_id = docs.schema["doc_id"]
    long = T.LongType()

    def schema(*fields: T.StructField | str) -> T.StructType:
        # never null: else joins add filters, each its own, and equal shuffles are no longer seen as equal
        return T.StructType([T.StructField(f, T.IntegerType() if f == "n" else long, False) if isinstance(f, str) else f for f in fields])

    def texts_with(runs: DataFrame, how: str) -> DataFrame:
        return docs.join(runs, ["doc_id", "mark"], how).select(*docs.columns, "runs")

    found = docs.mapInArrow(_first_level(length, quarter), schema(doc_id, "value", "at", "n", "runs_held"))
    # written: what follows names it many times, and each time its whole plan would be planned again
    left = stored(_by_text(_repeated(found)), "windows-left", compression="zstd")

    runs = schema(doc_id, "value", "words", "at", "n", "runs_held", T.StructField("sure", T.BooleanType(), False))
    all_found = texts_with(left, "inner").mapInArrow(_second_level(length, half), runs)
    sure, found = all_found.where("sure").select("doc_id", "at", "n"), _repeated(all_found.where("NOT sure"))
    order = F.struct("doc_id", "at", "n")
    equal = found.groupBy("value", "words").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("c"))
    again = found.join(equal.where("c > 1").select("value", "words", "first"), ["value", "words"])
    again = again.where("struct(doc_id, at, n) > first").select("doc_id", "at", "n")
    # counted over all columns of ``equal``, so that one shuffle serves its three uses
    several = equal.groupBy("value").agg(F.count_if((F.col("c") > 0) & F.col("first").isNotNull()).alias("kinds")).where("kinds > 1").select("value")
    open_runs = equal.join(several, "value", "left_semi").select("first.*")

    all_found = texts_with(_by_text(open_runs), "inner").mapInArrow(_last_level(length), runs)
    sure, found = sure.union(all_found.where("sure").select("doc_id", "at", "n")), all_found.where("NOT sure")
    equal = found.groupBy("value", "words").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("c"))
    more = found.join(equal.where("c > 1").select("value", "words", "first"), ["value", "words"])
    more = more.where("struct(doc_id, at) > first").select("doc_id", "at", "n")

    carried = [docs.schema["carried"]] if others else []
    result = schema(doc_id, *carried, "n_words", "n_removed", T.StructField("kept", T.StringType()))
    out = texts_with(_by_text(again.union(more).union(sure)), "left").mapInArrow(_cut(length, digest), result)
    return out.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), *[F.col("carried").getField(c).alias(c) for c in others], "n_words", "n_removed", "kept")
