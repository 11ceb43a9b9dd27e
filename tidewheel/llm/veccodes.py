"""Vectors as short codes: equal parts, each by the number of its nearest entry in a codebook of its own.

Components become integers, so that distances are exact, and codebooks are refined by Lloyd's rounds. A round stores
each part's entry and exact distance. In the next one only entries that moved can come nearer to a part whose own
entry stayed where it was, so that part is compared with the moved entries alone, against its stored distance; a part
whose entry moved is compared with all. Of equally near entries the lower number is taken in both cases.

Distances are whole numbers in doubles if all of them are below 2**53, else Python integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.tables import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows taken at once.
ROWS = 2048
#: Labels that more than one in so many rows have are broadcast, the others joined.
HOT_SHARE = 1000
LONG_MAX = (1 << 63) - 1
_COPIED = ["vec_id", "label", "ints"]


@dataclass
class Books:
    """Codebooks of all parts as (parts, entries, width), those of the round before, and how to calculate."""

    now: np.ndarray
    before: np.ndarray | None
    exact: bool  # Python integers

    @property
    def kind(self) -> type:
        return object if self.exact else np.float64


def _floored(x: float, scale: int) -> int:
    return int(np.floor(x * scale)) if abs(x) < 2.0**43 else int(Fraction(x) * scale // 1)


def integers(row: list[float] | None, parts: int = PARTS, scale: int = SCALE) -> list[int] | None:
    """floor(scale * x) of each component, padded with zeros to equal parts; None if there is a component that is none."""
    if row is None or any(x is None or not np.isfinite(x) for x in row):
        return None
    return [_floored(x, scale) for x in row] + [0] * (-len(row) % parts)


def _to_bytes(ints: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes: four for each number if that will do, else decimal text."""
    if ints.dtype != object:
        return [r.tobytes() for r in ints.astype("<i4")]
    return [",".join(map(str, r)).encode() for r in ints.tolist()]


def _from_bytes(column: pa.Array, exact: bool) -> np.ndarray:
    if not exact:
        return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), -1).astype(np.float64)
    rows = [list(map(int, b.decode().split(","))) if b else [] for b in column.to_pylist()]
    return np.array(rows, dtype=object).reshape(len(rows), -1)


def _read(parts: int, scale: int) -> Callable:
    """(vec_id, label, width, most, ints): vectors as integers of four bytes each below 2**30, else in decimal text;
    ``most`` is the exponent of a power of two above all of them. Rows with a component that is no number are left out."""
    names = ["vec_id", "label", "width", "most", "ints"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                vectors = batch.column("embedding")
                lengths = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
                values = vectors.flatten()
                dim = int(lengths[0]) if len(lengths) and not np.isnan(lengths[0]) else 0
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                regular = vectors.null_count == 0 and values.null_count == 0 and dim and (lengths == dim).all()
                if regular and np.isfinite(x).all() and np.abs(x).max(initial=0) * scale < 2**30 - 1:
                    ints = np.floor(x * scale).astype(np.int64).reshape(-1, dim)
                    ints = np.pad(ints, ((0, 0), (0, -dim % parts)))
                    rows, width = np.arange(len(ints)), np.full(len(ints), ints.shape[1])
                    most = [int(m).bit_length() for m in np.abs(ints).max(1, initial=0)]
                    data = _to_bytes(ints)
                else:
                    found = [(i, r) for i, v in enumerate(vectors.to_pylist()) if (r := integers(v, parts, scale)) is not None]
                    rows, width = [i for i, _ in found], [len(r) for _, r in found]
                    most = [max((abs(n) for n in r), default=0).bit_length() for _, r in found]
                    data = [_to_bytes(np.array([r], dtype=object if m > 30 else np.int64))[0] for (_, r), m in zip(found, most, strict=True)]
                at = pa.array(rows, pa.int64())
                arrays = [batch.column("vec_id").take(at), batch.column("label").take(at), pa.array(width, pa.int32()), pa.array(most, pa.int32())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(data, pa.binary())], names)

    return run


def _as_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integers of four bytes to decimal text, where some vector of this width needs that."""
    for batch in batches:
        few = [np.frombuffer(b, "<i4").tolist() if m <= 30 else None for b, m in zip(batch.column("ints").to_pylist(), batch.column("most").to_pylist(), strict=True)]
        data = [b if r is None else ",".join(map(str, r)).encode() for r, b in zip(few, batch.column("ints").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("vec_id", "label")], pa.array(data, pa.binary())], _COPIED)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries, in the numbers they come in."""
    if x.dtype == object:
        return ((x[:, None, :] - entries[None]) ** 2).sum(2) if x.shape[1] else np.zeros((len(x), len(entries)), object)
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = distances(x, entries)
    at = d.argmin(1)  # the first of equals
    return at, d[np.arange(len(x)), at]


def reassigned(x: np.ndarray, old: np.ndarray, new: np.ndarray, at: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entries of ``new`` given those of ``old`` with their distances; and how many comparisons that took."""
    moved = np.flatnonzero((old != new).any(1))
    at, d, done = at.copy(), d.copy(), 0
    if not len(moved):
        return at, d, done
    away = np.isin(at, moved)
    if away.any():
        at[away], d[away] = nearest(x[away], new)
        done += int(away.sum()) * len(new)
    stays = np.flatnonzero(~away)
    if len(stays):
        near, dist = nearest(x[stays], new[moved])
        near = moved[near]
        better = (dist < d[stays]) | ((dist == d[stays]) & (near < at[stays]))
        at[stays[better]], d[stays[better]] = near[better], dist[better]
        done += len(stays) * len(moved)
    return at, d, done


def _assigned(shared) -> Callable:
    """(vec_id, label, ints, code, far): each part's entry and its distance, from those of the round before if there was one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Books = shared.value
        parts, _, width = books.now.shape
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = _from_bytes(batch.column("ints"), books.exact).reshape(batch.num_rows, parts, width)
                at = np.zeros((len(x), parts), np.int64)
                d = np.zeros((len(x), parts), books.kind)
                if books.before is not None:
                    at = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(x), parts).astype(np.int64)
                    d = _far(batch.column("far"), books.exact, parts).copy()
                for p in range(parts):
                    if books.before is None:
                        at[:, p], d[:, p] = nearest(x[:, p], books.now[p])
                    else:
                        at[:, p], d[:, p], _ = reassigned(x[:, p], books.before[p], books.now[p], at[:, p], d[:, p])
                code = [r.tobytes() for r in at.astype(np.uint8)]
                far = [",".join(map(str, r)).encode() for r in d.tolist()] if books.exact else [r.tobytes() for r in d.astype("<f8")]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _COPIED], pa.array(code, pa.binary()), pa.array(far, pa.binary())], [*_COPIED, "code", "far"])

    return run


def _far(column: pa.Array, exact: bool, parts: int) -> np.ndarray:
    return _from_bytes(column, True) if exact else np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, parts)


def _sums(shared) -> Callable:
    """(slot, n, sums) over a task's rows: how many parts an entry has, and the sums of their components as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Books = shared.value
        parts, entries, width = books.now.shape
        n, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), object if books.exact else np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = _from_bytes(batch.column("ints"), books.exact).reshape(batch.num_rows * parts, width)
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
                slots = (code + np.arange(parts) * entries).ravel()
                n += np.bincount(slots, minlength=len(n))
                some = np.zeros((len(n), width), books.kind)
                np.add.at(some, slots, x)
                sums += some.astype(sums.dtype)  # numbers below 2**26, or Python integers
        used = np.flatnonzero(n)
        texts = [list(map(str, r)) for r in sums[used].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used]), pa.array(texts, pa.list_(pa.string()))], ["slot", "n", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of :func:`_sums` of some slots, added up."""
    n, sums = {}, {}
    for batch in batches:
        for row in batch.to_pylist():
            slot, more = row["slot"], [int(s) for s in row["sums"]]
            n[slot] = n.get(slot, 0) + row["n"]
            sums[slot] = [a + b for a, b in zip(sums[slot], more, strict=True)] if slot in sums else more
    texts = [list(map(str, sums[s])) for s in n]
    yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64()), pa.array(texts, pa.list_(pa.string()))], ["slot", "n", "sums"])


def _refined(state: DataFrame, books: Books) -> np.ndarray:
    """Each entry the floor of the mean of its parts; an entry without parts as it is. Comes to the driver as one row for
    each entry."""
    parts, entries, width = books.now.shape
    kinds = "slot int, n long, sums array<string>"
    partial = state.select("ints", "code").mapInArrow(_sums(state.sparkSession.sparkContext.broadcast(books)), kinds)
    book = books.now.reshape(parts * entries, width).copy()
    for row in partial.repartition("slot").mapInArrow(_added, kinds).collect():
        book[row.slot] = [int(s) // row.n for s in row.sums]
    return book.reshape(books.now.shape)


def _ended(exact: bool, parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                error = [int(sum(r)) for r in _far(batch.column("far"), exact, parts).tolist()]
                code = [c.hex() for c in batch.column("code").to_pylist()]
                error = [e if e <= LONG_MAX else None for e in error]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def _with_label_error(rows: DataFrame) -> DataFrame:
    """Rows with the sum of errors of their label. A label of many rows is broadcast, of which there are few by count."""
    totals = rows.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count("error").alias("known"), F.count(F.lit(1)).alias("n"))
    total = F.when(F.col("known") == F.col("n"), F.expr("try_cast(total AS long)")).alias("label_error")
    totals = stored(totals.select("of", total, "n"), "labels")
    limit = (totals.agg(F.sum("n")).first()[0] or 0) / HOT_SHARE
    hot = F.broadcast(totals.where(F.col("n") > limit).drop("n"))
    same = rows["label"].eqNullSafe(F.col("of"))
    out = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    often, seldom = rows.join(hot, same).select(out), rows.join(hot, same, "left_anti")
    return often.union(seldom.join(totals.where(F.col("n") <= limit), seldom["label"].eqNullSafe(F.col("of"))).select(out))


def codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for each row of ``embeddings`` (vec_id, embedding, label).

    Rows whose vector is null or holds null or non-finite components are left out. A codebook starts as its part of the
    first ``entries`` vectors by vec_id (then by the vector; nulls last), or of as many as there are. ``code`` is two hex
    digits for each part, ``error`` the squared distances summed over parts, ``label_error`` the errors summed over equal
    labels. Vectors of another length get codebooks of their own; a length that can't be cut into equal parts is filled
    up with zeros at the end; empty vectors have entries of no components. Sums beyond a long are null. Ids may be null or repeat. Extra columns are not looked at. No vectors give
    no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number must fit two hex digits")
    spark = embeddings.sparkSession
    vectors = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    same = [vectors.schema[c] for c in ("vec_id", "label")]
    kinds = [T.StructField("width", T.IntegerType()), T.StructField("most", T.IntegerType()), T.StructField("ints", T.BinaryType())]
    known = stored(vectors.mapInArrow(_read(parts, scale), T.StructType([*same, *kinds])), "integers")
    # one row for each length of vectors
    widths = known.groupBy("width").agg(F.max("most").alias("most")).orderBy("width").collect()
    state_kind = T.StructType([*same, T.StructField("ints", T.BinaryType()), *[T.StructField(c, T.BinaryType()) for c in ("code", "far")]])
    out = None
    for r in widths:
        width = r.width // parts
        # each component of a difference is below 2**(most + 1)
        exact = r.most > 26 or width << (2 * r.most + 2) >= 1 << 53
        rows = known.where(F.col("width") == r.width)
        rows = rows.mapInArrow(_as_text, T.StructType([*same, kinds[-1]])) if exact else rows.select(_COPIED)
        first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
        seeds = _from_bytes(pa.array([f.ints for f in first], pa.binary()), exact).reshape(len(first), parts, width)
        books = Books(np.ascontiguousarray(seeds.transpose(1, 0, 2)), None, exact)
        state = rows
        for i in range(rounds + 1):
            state = stored(state.mapInArrow(_assigned(spark.sparkContext.broadcast(books)), state_kind), "codes")
            if i < rounds:
                books = Books(_refined(state, books), books.now, exact)
        ended = state.mapInArrow(_ended(exact, parts), T.StructType([*same, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))
        numbers = ",".join(str(int(n)) for n in books.now.ravel().tolist())
        ended = ended.withColumn("codebooks_sha256", F.lit(hashlib.sha256(numbers.encode()).hexdigest()))
        out = ended if out is None else out.union(ended)
    if out is None:
        kinds = [("code", T.StringType()), ("error", T.LongType()), ("label_error", T.LongType()), ("codebooks_sha256", T.StringType())]
        return spark.createDataFrame([], T.StructType([same[0], *[T.StructField(n, t) for n, t in kinds]]))
    return _with_label_error(out)
