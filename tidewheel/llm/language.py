"""A log-bilinear language model: counts over the whole training corpus, noise-contrastive estimation, exact scores.

Spark counts all words of the training texts. The commonest ``HEAD`` words are symbols of the model; every other word
belongs to one of ``TAILS`` further symbols by its ending. The model gives a symbol's vector, by a matrix product with
that of the symbol before, its score; it is trained in numpy on how often each two symbols follow each other, counted
over all training texts, against noise drawn from the symbols' own frequencies. One batched product then gives the
normalised probabilities of every symbol after every other. A word of a tail symbol is that symbol times the word's
smoothed share of it, so a text's probability is one over all words, seen or not.

What is gathered to the driver is bounded: ``KNOWN`` words with their counts and (HEAD + TAILS)**2 pairs. The counts of
rarer words stay in their table and are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.hashing import Chunk, chunks, mix
from tidewheel.llm.tables import stored

HEAD, TAILS, KNOWN = 960, 64, 1 << 19
DIM, NOISE, STEPS, RATE, SEED = 48, 10, 150, 0.05, 5
#: Stands for the end of a text in the table of counts; its symbol is 0.
END_WORD = int(mix(np.array([0xE0F], np.uint64)).view(np.int64)[0])


def trained_on(doc_id: Column) -> Column:
    """Whether a document is learned from: crc32 of the id as text, modulo 7, is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 != 2, F.lit(False))


def _tail(ending: np.ndarray) -> np.ndarray:
    return (mix(ending.astype(np.uint64)) % np.uint64(TAILS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text"), lower=True):
            words, at, n = np.unique(chunk.words.view(np.int64), return_index=True, return_counts=True)
            words = np.concatenate((words, [END_WORD]))
            tail = np.concatenate((_tail(chunk.ending[at]), [0]))
            n = np.concatenate((n, [chunk.rows]))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(tail.astype(np.int32)), pa.array(n)], ["word", "tail", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, tail, n) over all texts: the hash of each distinct word, the tail it would belong to, its count. Each text adds one end."""
    return texts.select("text").mapInArrow(_counted, "word long, tail int, n long").groupBy("word").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    words: np.ndarray  # sorted hashes of the known words
    counts: np.ndarray
    symbols: np.ndarray  # of the known words: below HEAD for the commonest, else by their tail
    tokens: int  # N, all training tokens
    distinct: int  # V, the end included
    tail_mass: np.ndarray  # for each symbol log10 of the training tokens + types + 1 of the words that share it

    def look_up(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Each word's symbol and count, -1 where the count is not known here."""
        words = chunk.words.view(np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        found = self.words[at] == words
        return np.where(found, self.symbols[at], HEAD + _tail(chunk.ending)), np.where(found, self.counts[at], -1)


def _bytes(names: list[str], kinds: list[type]) -> Callable:
    """Columns as binaries, one row for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [pa.array([b.column(c).to_numpy(zero_copy_only=False).astype(k).tobytes()], pa.binary()) for c, k in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(packed, names)

    return run


def vocabulary(counts: DataFrame, known: int = KNOWN) -> Vocabulary:
    """The ``known`` commonest words of the table of counts (fewer, so that all of one count are in or out)."""
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    # a row for each distinct count, of which a corpus of N tokens has sqrt(2 N) at most; those that can matter are fewer
    ranked = steps.orderBy(F.desc("n")).limit(known).collect()
    total, least = 0, None
    for r in ranked:
        total += r.words
        if total > known:
            break
        least = r.n
    kept = counts.where(F.col("n") >= F.lit(least if least is not None else 1 << 62)) if ranked else counts
    kept = kept.where(F.col("word") != END_WORD).union(counts.where(F.col("word") == END_WORD))
    rows = kept.select("word", "tail", "n").mapInArrow(_bytes(["word", "tail", "n"], [np.int64, np.int32, np.int64]), "word binary, tail binary, n binary").collect()
    word, tail, n = (np.concatenate([np.frombuffer(r[i], k) for r in rows] or [np.zeros(0, k)]) for i, k in enumerate((np.int64, np.int32, np.int64)))
    order = np.lexsort((word, -n, word != END_WORD))  # the end is symbol 0
    word, tail, n = word[order], tail[order], n[order]
    symbols = np.where(np.arange(len(word)) < HEAD, np.arange(len(word)), HEAD + tail)
    by_tail = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    tokens, distinct = sum(r.n for r in by_tail), sum(r.types for r in by_tail)
    mass = np.zeros(HEAD + TAILS)
    for r in by_tail:
        mass[HEAD + r.tail] = r.n + r.types
    np.subtract.at(mass, HEAD + tail[:HEAD], n[:HEAD] + 1)  # words that are symbols themselves
    sort = np.argsort(word)
    if not len(word):
        word, n, symbols, sort = np.array([END_WORD]), np.array([0]), np.array([0]), np.array([0])
    return Vocabulary(word[sort], n[sort], symbols[sort], tokens, distinct, np.log10(np.maximum(mass, 0) + 1))


def _with_ends(chunk: Chunk, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, symbol before, symbol) of all tokens of the chunk, the ends of texts included."""
    ends = chunk.bounds[1:]
    now = np.insert(symbols, ends, 0)
    row = np.insert(np.repeat(np.arange(chunk.rows), np.diff(chunk.bounds)), ends, np.arange(chunk.rows))
    return row, np.concatenate(([0], now[:-1])), now


def _followed(shared) -> Callable:
    size = HEAD + TAILS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                _, before, now = _with_ends(chunk, shared.value.look_up(chunk)[0])
                total += np.bincount(before * size + now, minlength=size * size)
        cells = np.flatnonzero(total)
        for a in range(0, len(cells), 100_000):
            part = cells[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["cell", "n"])

    return run


def estimated(pairs: np.ndarray, steps: int = STEPS, dim: int = DIM) -> np.ndarray:
    """log10 of the probability of each symbol (column) after each other (row).

    Trained by noise-contrastive estimation on a matrix of counts: of ``NOISE`` + 1 candidates for each pair counted,
    one is the symbol that followed and the others are noise; their expected numbers stand for drawn ones.
    """
    rng = np.random.default_rng(SEED)
    size = len(pairs)
    own = pairs.sum(0) + 1.0
    own /= own.sum()
    seen = (pairs / max(1.0, pairs.sum())).astype(np.float32)
    times = seen.sum(1, keepdims=True) + np.float32(1e-7)
    noise = (np.log(own) + np.log(NOISE)).astype(np.float32)
    expected = (NOISE * own).astype(np.float32) * times
    weights = [rng.normal(0, 0.1, (size, dim)).astype(np.float32), rng.normal(0, 0.1, (size, dim)).astype(np.float32), np.log(own).astype(np.float32)]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, steps + 1):
        before, after, bias = weights
        data = 1 / (1 + np.exp(np.clip(noise - (before @ after.T + bias), -40, 40)))
        slope = (expected * data - seen * (1 - data)) * np.float32(size)
        grads = [slope @ after, slope.T @ before, slope.sum(0)]
        for w, g, mi, vi in zip(weights, grads, m, v, strict=True):
            mi += 0.1 * (g - mi)
            vi += 0.01 * (g * g - vi)
            rate = RATE * (1 - t / (steps + 1))
            w -= (rate * mi / (1 - 0.9**t) / (np.sqrt(vi / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    before, after, bias = weights
    scores = (before @ after.T + bias).astype(np.float64)
    top = scores.max(1, keepdims=True)
    return ((scores - top - np.log(np.exp(scores - top).sum(1, keepdims=True))) / np.log(10)).astype(np.float32)


def _parts(shared, table) -> Callable:
    """For each text what its known words give, but for log10(c + 1) of the rarer ones: a row for each of those with its hash and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, logs = shared.value, table.value
        key = TaskContext.get().partitionId() << 40
        names = ["key", "doc_id", "word", "n", "n_known", "base", "score"]
        whole = np.log10(vocabulary.tokens + vocabulary.distinct + 1)
        end_count = vocabulary.counts[np.searchsorted(vocabulary.words, END_WORD)]
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                symbols, counts = vocabulary.look_up(chunk)
                row, before, now = _with_ends(chunk, symbols)
                count = np.insert(counts, chunk.bounds[1:], end_count)
                known = count >= 0
                share = np.where(known, np.log10(np.maximum(count, 0) + 1.0), 0)
                base = np.bincount(row, share - whole, chunk.rows)
                score = np.bincount(row, logs[before, now] + np.where(now >= HEAD, share - vocabulary.tail_mass[now], 0), chunk.rows)
                n = np.diff(chunk.bounds) + 1
                n_known = np.bincount(row, count > 0, chunk.rows).astype(np.int64)
                keys = key + np.arange(chunk.rows)
                key += chunk.rows
                ids = batch.column("doc_id").slice(chunk.first, chunk.rows)
                none = pa.nulls(chunk.rows, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys), ids, none, pa.array(n), pa.array(n_known), pa.array(base), pa.array(score)], names)
                rare = counts < 0
                if rare.any():
                    words = np.stack((np.repeat(np.arange(chunk.rows), np.diff(chunk.bounds))[rare], chunk.words.view(np.int64)[rare]))
                    order = np.lexsort(words[::-1])
                    words = words[:, order]
                    new = np.flatnonzero(np.concatenate(([True], (words[:, 1:] != words[:, :-1]).any(0))))
                    times = np.diff(np.concatenate((new, [words.shape[1]])))
                    k = len(new)
                    nothing = pa.nulls(k, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[words[0, new]]), nothing.cast(ids.type), pa.array(words[1, new]), pa.array(times), nothing, nothing.cast(pa.float64()), nothing.cast(pa.float64())],
                        names,
                    )

    return run


def scored(documents: DataFrame, learn: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens (long), base_score and score (double) of every row of ``documents``.

    The model is trained on the rows for which ``learn`` holds. Words are split at the blanks 0x20, 0x09 to 0x0D, A-Z
    lower-cased; a text is its words and one end. ``base_score`` sums log10((c + 1) / (N + V + 1)), ``score`` is the
    model's log10 of the text's probability.

    A null or empty text is one end. Ids may be null or repeat; rows stay apart. Other columns are not looked at. With
    nothing to learn from, all words are unknown.
    """
    spark = documents.sparkSession
    training = documents.where(learn).select("text")
    counts = stored(word_counts(training), "word-counts")
    known = vocabulary(counts)
    shared = spark.sparkContext.broadcast(known)
    size = HEAD + TAILS
    pairs = training.mapInArrow(_followed(shared), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = pairs.mapInArrow(_bytes(["cell", "n"], [np.int32, np.int64]), "cell binary, n binary").collect()  # size**2 cells at most
    matrix = np.zeros(size * size)
    for r in rows:
        matrix[np.frombuffer(r.cell, np.int32)] = np.frombuffer(r.n, np.int64)
    table = spark.sparkContext.broadcast(estimated(matrix.reshape(size, size)))

    docs = documents.select("doc_id", "text")
    kinds = f"key long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, word long, n long, n_known long, base double, score double"
    parts = stored(docs.mapInArrow(_parts(shared, table), kinds), "score-parts")
    rare = parts.where("word IS NOT NULL").select("key", "word", "n").join(counts.select("word", F.col("n").alias("c")), "word", "left")
    gain = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)
    rare = rare.groupBy("key").agg(F.sum(gain).alias("gain"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"))
    plus = F.coalesce("gain", F.lit(0.0))
    return (
        parts.where("word IS NULL")
        .join(rare, "key", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_tokens"),
            (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(known.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + plus).alias("base_score"),
            (F.col("score") + plus).alias("score"),
        )
    )
