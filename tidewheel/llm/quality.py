"""Quality classifier: random-indexing word vectors pooled by document, and a two-layer network.

Each token is hashed to one of ``SLOTS`` slots. A slot has a fixed sparse random index vector, and a context vector,
the sum of the index vectors of its neighbours in all texts. A text's vector is the mean of both over its tokens. A
two-layer numpy network with a temperature fitted on a part of the rows set apart makes it a probability.

Only the fit of the network is bounded: it takes ``FIT_ROWS`` labelled rows, the first by a hash of doc_id. Context
vectors and scores cover all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.hashing import BYTE_BASE, _ranges, mix
from tidewheel.llm.tables import stored

FIT_ROWS = 20_000
SLOTS, DIM, SEEDS, REACH = 4096, 64, 4, 2
HIDDEN, EPOCHS, RATE, SEED = 32, 60, 0.01, 7
THRESHOLD = 0.3
#: Bytes of text taken at once (a longer text is taken alone), rows pooled at once, rows of a batch taken at once.
CHUNK_BYTES, BLOCK, ROWS = 256 << 10, 128, 512
#: Slots of marks that no word is hashed to: a word that is the one before, a word in capitals only.
AGAIN, CAPITALS, MARKS = 0, 1, 2

_KIND = np.full(256, 2, np.uint8)  # 0 blank, 1 letters, digits and all beyond ASCII, 2 the rest
_KIND[[9, 10, 11, 12, 13, 32]] = 0
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _KIND[_a:_b] = 1


def index_vectors() -> np.ndarray:
    """For each slot a vector with a few entries of +1 and -1, else 0."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((SLOTS, DIM), np.float32)
    for row in out:
        row[rng.choice(DIM, SEEDS, replace=False)] = rng.choice([-1, 1], SEEDS)
    return out


def _tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """By chunk of rows: first row, number of rows, each token's row and slot, and the (row, slot) of marks."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, body = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        data, at = body[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        kind = _KIND[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        change = np.flatnonzero(edge[:-1] | (np.concatenate(([3], kind[:-1])) != kind)) if len(data) else np.zeros(0, np.int64)
        starts, ends = change, np.concatenate((change[1:], [len(data)]))[: len(change)]
        solid = kind[starts] > 0
        starts, ends = starts[solid], ends[solid]
        words = mix(_ranges(data.astype(np.uint64) + np.uint64(1), starts, ends, BYTE_BASE))
        row = np.searchsorted(at, starts, "right") - 1
        slot = (words % np.uint64(SLOTS - MARKS)).astype(np.int64) + MARKS
        again = np.zeros(len(words), bool)
        again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
        upper = np.concatenate(([0], np.cumsum((data >= 0x41) & (data <= 0x5A))))
        capitals = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 1)
        marks = np.concatenate((row[again] * SLOTS + AGAIN, row[capitals] * SLOTS + CAPITALS))
        yield first, stop - first, row, slot, marks
        first = stop


def _pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """The mean of the vectors of each text's tokens and marks, zero for a text without any."""
    out = np.zeros((len(texts), vectors.shape[1]), np.float32)
    for first, rows, row, slot, marks in _tokens(texts):
        for a in range(0, rows, BLOCK):
            b = min(rows, a + BLOCK)
            i, j = np.searchsorted(row, (a, b))
            here = marks[(marks >= a * SLOTS) & (marks < b * SLOTS)]
            cells = np.concatenate((row[i:j] * SLOTS + slot[i:j], here)) - a * SLOTS
            counts = np.bincount(cells, minlength=(b - a) * SLOTS).reshape(b - a, SLOTS).astype(np.float32)
            size = np.maximum(np.bincount(row[i:j] - a, minlength=b - a), 1)
            out[first + a : first + b] = counts @ vectors / size[:, None]
    return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, v0, v1, ...): the sum of neighbours' index vectors for each slot over the task's texts. Whole numbers."""
    index, total = index_vectors(), np.zeros((SLOTS, DIM), np.float64)
    for batch in batches:
        for _, _, row, slot, _ in _tokens(batch.column("text")):
            if not len(row):
                continue
            pairs = [np.zeros(0, np.int64)]
            for d in range(1, REACH + 1):
                near = row[d:] == row[:-d]
                a, b = slot[:-d][near], slot[d:][near]
                pairs += [a * SLOTS + b, b * SLOTS + a]
            cells, n = np.unique(np.concatenate(pairs), return_counts=True)
            if len(cells):
                own = cells // SLOTS
                cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                for c in range(0, len(cuts), 512):
                    i, j = cuts[c], cuts[c + 512] if c + 512 < len(cuts) else len(cells)
                    part = index[cells[i:j] % SLOTS] * n[i:j, None]
                    total[own[cuts[c : c + 512]]] += np.add.reduceat(part, cuts[c : c + 512] - i, axis=0)
    some = np.flatnonzero(total.any(1))
    columns = [pa.array(some, pa.int32()), *[pa.array(total[some, i]) for i in range(DIM)]]
    yield pa.RecordBatch.from_arrays(columns, ["slot", *[f"v{i}" for i in range(DIM)]])


def context_vectors(documents: DataFrame) -> np.ndarray:
    """The context vector of each slot over all texts, of unit length or zero. A row for each slot comes to the driver."""
    kinds = "slot int, " + ", ".join(f"v{i} double" for i in range(DIM))
    sums = documents.select("text").mapInArrow(_contexts, kinds).groupBy("slot").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(DIM)])
    out = np.zeros((SLOTS, DIM))
    for r in sums.collect():
        out[r.slot] = r[1:]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        x = (_pooled(texts, self.vectors) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2).astype(np.float64)


def trained_on(doc_id: Column) -> Column:
    """Whether labels of a document may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


def _train(model: Model, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
    """Adam on the cross entropy, then the temperature that suits the fifth of rows not trained on best."""
    apart = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.zeros(len(y), bool)
    fit_x, fit_y = x[~apart], y[~apart]
    weights = [model.w1, model.b1, model.w2, np.array([model.b2], np.float32)]
    m, v, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(fit_y))
        for a in range(0, len(order), 256):
            bx, by = fit_x[order[a : a + 256]], fit_y[order[a : a + 256]]
            h = np.tanh(bx @ weights[0] + weights[1])
            d = (1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -50, 50))) - by) / len(by)
            dh = np.outer(d, weights[2]) * (1 - h * h)
            grads = [bx.T @ dh + 1e-4 * weights[0], dh.sum(0), h.T @ d + 1e-4 * weights[2], d.sum(keepdims=True)]
            t += 1
            for w, g, mi, vi in zip(weights, grads, m, v, strict=True):
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                w -= (RATE * mi / (1 - 0.9**t) / (np.sqrt(vi / (1 - 0.999**t)) + 1e-8)).astype(w.dtype)
    model.w1, model.b1, model.w2, model.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if apart.any():
        z = model.logits(x[apart])

        def loss(temp: float) -> float:
            return float(np.mean(np.logaddexp(0, np.where(y[apart] > 0, -z, z) / temp)))

        model.temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)


def fit(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """The classifier learned from ``rows`` labelled documents at most; None if they don't show both labels."""
    spark = documents.sparkSession
    known = labels.where(F.col("quality").isin(0, 1) & trained_on(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # 16 bytes a row
    sample = stored(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "fit")
    context = context_vectors(documents)
    vectors = np.hstack((index_vectors(), context)).astype(np.float32)
    shared = spark.sparkContext.broadcast(vectors)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = [r.tobytes() for r in _pooled(batch.column("text"), shared.value)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(x, pa.binary())], ["doc_id", "quality", "x"])

    known_rows = sample.mapInArrow(pooled, T.StructType([sample.schema["doc_id"], sample.schema["quality"], T.StructField("x", T.BinaryType())])).collect()
    known_rows.sort(key=lambda r: (r.doc_id, r.x))
    y = np.array([r.quality for r in known_rows], np.float32)
    if len(set(y.tolist())) < 2:
        return None
    x = np.stack([np.frombuffer(r.x, np.float32) for r in known_rows])
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    x, y = x[order], y[order]
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    w1 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)).astype(np.float32)
    w2 = rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32)
    model = Model(vectors, mean, scale, w1, np.zeros(HIDDEN, np.float32), w2, 0.0, 1.0)
    _train(model, x, y, rng)
    return model


def _scored(model: Model | None, rejected_go: bool, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                score = np.ones(batch.num_rows) if model.value is None else model.value.scores(batch.column("text"))
                if rejected_go:
                    yield batch.filter(pa.array(score >= THRESHOLD))
                else:
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names)

    return run


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (0 to 1; higher: the label 1 is likelier) of every row. Null and empty texts are scored as texts without tokens.

    Without a model (no labels to learn from) every score is 1. Ids may be null or repeat; other columns are not looked at.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(_scored(shared, False, ["doc_id", "score"]), T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def accepted(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``documents``, with all their columns, whose score is ``THRESHOLD`` or more."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return documents.mapInArrow(_scored(shared, True, []), documents.schema)
