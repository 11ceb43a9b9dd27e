"""Near-duplicate vectors by an inverted multi-index.

Vectors are halved and each half has its own codebook, so k centroids a half make a grid of k * k cells. A vector
lies in one cell and visits the cells nearest to it, by the sum of its halves' distances (the multi-sequence order:
a cell's turn comes after those nearer in both halves), until the target recall. How many cells that takes is measured
on pairs just at the threshold. What it meets in a cell is verified exactly.

Codebooks are fitted on a bounded sample; every vector is indexed and every vector searches. Equal vectors are one
class. Large cells are dealt to blocks; a block counts links and reduces them to a spanning forest there and then.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.components import smallest_reachable
from tidewheel.llm.jaccard import forest, groups
from tidewheel.llm.tables import stored

THRESHOLD, RECALL = 0.95, 0.97
#: Bytes of vectors that codebooks are fitted on; vectors aimed at in a cell; the most centroids a half may have.
FIT_BYTES, CELL, MAX_CENTROIDS = 8 << 20, 64, 512
#: Vectors on either side of a block.
BLOCK = 1024
SEED, ROUNDS = 11, 12


@dataclass
class Index:
    first: np.ndarray  # codebook of the first half
    second: np.ndarray
    visits: int = 1

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = x.shape[1] // 2
        return _squared(x[:, :half], self.first), _squared(x[:, half:], self.second)

    def homes(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def visited(self, x: np.ndarray, visits: int) -> tuple[np.ndarray, np.ndarray]:
        """The cells each vector visits, nearest first, and how far the last of them is."""
        a, b = self.distances(x)
        order_a, order_b = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
        i, j = np.meshgrid(np.arange(min(visits, a.shape[1])), np.arange(min(visits, b.shape[1])), indexing="ij")
        stairs = (i + 1) * (j + 1) <= visits  # all others come after ``visits`` nearer cells
        i, j = i[stairs], j[stairs]
        sums = np.take_along_axis(a, order_a[:, i], 1) + np.take_along_axis(b, order_b[:, j], 1)
        n = min(visits, sums.shape[1])
        best = sums.argsort(1, kind="stable")[:, :n]
        cells = np.take_along_axis(order_a, i[best], 1) * len(self.second) + np.take_along_axis(order_b, j[best], 1)
        return cells, np.take_along_axis(sums, best[:, -1:], 1)[:, 0]

    def rank(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Which in the order of visits each vector's cell is, from 1. Cells are counted, not listed."""
        a, b = self.distances(x)
        to = a[np.arange(len(x)), cells // len(self.second)] + b[np.arange(len(x)), cells % len(self.second)]
        return np.array([np.searchsorted(np.sort(b[i]), t - a[i]).sum() + 1 for i, t in enumerate(to * (1 - 1e-12))])


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means from k rows drawn at random; an empty centre is set to a row drawn anew."""
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = _squared(x, centres).argmin(1)
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], x[rng.integers(0, len(x), k)])
    return centres


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fitted(sample: np.ndarray, rows: int, threshold: float = THRESHOLD, recall: float = RECALL, cell: int = CELL) -> Index:
    """The index for ``rows`` vectors from a sample of distinct ones, already of unit length."""
    rng = np.random.default_rng(SEED)
    k = max(1, min(MAX_CENTROIDS, math.ceil(math.sqrt(rows / cell)), len(sample) // 8))
    half = sample.shape[1] // 2
    index = Index(_centres(sample[:, :half], k, rng), _centres(sample[:, half:], k, rng))
    # partners just at the threshold, in random directions
    x = sample[rng.permutation(len(sample))[:1000]]
    away = rng.normal(size=x.shape)
    away = unit(away - (away * x).sum(1, keepdims=True) * x) if x.shape[1] > 1 else np.zeros_like(x)
    y = unit(threshold * x + math.sqrt(1 - threshold * threshold) * away)
    rank = np.full(len(x), k * k)
    for here, there in ((x, y), (y, x)):
        rank = np.minimum(rank, index.rank(here, index.homes(there)))
    index.visits = int(np.quantile(rank, recall, method="higher"))
    return index


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, dim, vector, name): the vector in doubles; null where it can't be compared."""
    for batch in batches:
        out = []
        for v in batch.column("embedding").to_pylist():
            x = None if v is None or not v or any(e is None for e in v) else np.array(v, np.float64)
            if x is not None and np.isfinite(x).all() and x.any():
                scale = np.abs(x).max()
                x = x / scale  # no square overflows or vanishes
                out.append(((x / np.sqrt((x * x).sum())) + 0.0).tobytes())
            else:
                out.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([None if o is None else len(o) // 8 for o in out], pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "vector"])


def _placed(shared, dim: int) -> Callable:
    """Each vector as a member of its cell and as a query of all cells it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        names = ["cell", "member", "node", "name", "weight", "home", "far", "vector"]
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                x = _matrix(batch.column("vector"), dim)
                cells, far = index.visited(x, index.visits)
                homes = index.homes(x)
                rows = np.concatenate((np.arange(len(x)), np.repeat(np.arange(len(x)), cells.shape[1])))
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((homes, cells.ravel())).astype(np.int64)),
                        pa.array(np.arange(len(rows)) < len(x)),
                        *(batch.column(c).take(at) for c in ("node", "name", "weight")),
                        pa.array(homes[rows].astype(np.int64)),
                        pa.array(far[rows]),
                        batch.column("vector").take(at),
                    ],
                    names,
                )

    return run


def _linked(shared, dim: int, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for table in groups(batches, "block"):
            member = table.column("member").to_numpy()
            mine, asks = table.filter(pa.array(member)), table.filter(pa.array(~member))
            if not len(mine) or not len(asks):
                continue
            y, x = _matrix(mine.column("vector"), dim), _matrix(asks.column("vector"), dim)
            q, m = np.nonzero(x @ y.T >= threshold)
            name_x, name_y = asks.column("name").to_numpy(), mine.column("name").to_numpy()
            other = name_x[q] != name_y[m]
            q, m = q[other], m[other]
            if not len(q):
                continue
            # a member that does not visit the cell of the query would never count the link itself
            home = asks.column("home").to_numpy()
            a, b = index.distances(y)
            k = len(index.second)
            sees = a[m, home[q] // k] + b[m, home[q] % k] <= mine.column("far").to_numpy()[m] * (1 + 1e-9)
            weight_x, weight_y = asks.column("weight").to_numpy(), mine.column("weight").to_numpy()
            links_x = np.bincount(q, weight_y[m], len(x))
            links_y = np.bincount(m[~sees], weight_x[q[~sees]], len(y))
            node = np.concatenate((asks.column("node").to_numpy(), mine.column("node").to_numpy()))
            name = np.concatenate((name_x, name_y))
            links = np.concatenate((links_x, links_y)).astype(np.int64)
            ids, rank = np.unique(node, return_inverse=True)
            root = ids[forest(len(ids), rank[q], rank[len(x) + m])][rank]
            some = np.flatnonzero((links > 0) | (root != node))
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(name[some]), pa.array(root[some]), pa.array(links[some])], ["node", "name", "root", "links"])

    return run


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id (long) and kept (boolean) for each row of ``embeddings`` (vec_id, embedding).

    Two vectors are linked if their cosine is at least ``threshold`` and one visits the other's cell; about ``recall``
    of pairs just at the threshold do, more of nearer ones. n_links counts the other rows linked with this one.

    Vectors that are null, empty, zero or hold null or non-finite components have no links, nor have rows without vec_id
    (their component is null and they are kept). Vectors of different lengths are never linked; each length has an index
    of its own. Rows that repeat a vec_id are linked if their vectors are. Other columns are not looked at.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    known = stored(rows.mapInArrow(_checked, "vec_id long, dim int, vector binary"), "vectors")
    usable = F.col("dim").isNotNull() & F.col("vec_id").isNotNull()
    # one row for each length of vectors
    dims = [r.dim for r in known.where(usable).select("dim").distinct().orderBy("dim").collect()]
    out = known.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    for dim in dims:
        named = known.where(usable & (F.col("dim") == dim)).select("vec_id", "vector", F.xxhash64("vector").alias("name"))
        out = _of_one_length(named, dim, threshold, recall, cell, block).union(out)
    return out


def _of_one_length(named: DataFrame, dim: int, threshold: float, recall: float, cell: int, block: int) -> DataFrame:
    """The result for rows (vec_id, vector, name) of ``dim`` components."""
    spark = named.sparkSession
    classes = named.groupBy("name").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    firsts = named.withColumnRenamed("vec_id", "node").dropDuplicates(["node", "name"]).join(classes, ["name", "node"])
    firsts = stored(firsts, "distinct-vectors")
    sample = firsts.orderBy(F.xxhash64("node", "name")).limit(max(64, FIT_BYTES // (8 * dim))).select("vector").collect()
    index = fitted(np.stack([np.frombuffer(r.vector, np.float64) for r in sample]), firsts.count(), threshold, recall, cell)
    shared = spark.sparkContext.broadcast(index)

    kinds = "cell long, member boolean, node long, name long, weight long, home long, far double, vector binary"
    placed = firsts.mapInArrow(_placed(shared, dim), kinds)
    # a row for each cell in use, so at most MAX_CENTROIDS squared of them
    sizes = placed.groupBy("cell").agg(F.count_if("member").alias("members"), F.count_if(~F.col("member")).alias("queries")).where("members > 0")
    parts = [F.ceil(F.col(c) / block).cast("int").alias(f"{c}_parts") for c in ("members", "queries")]
    dealt = placed.join(F.broadcast(sizes.select("cell", *parts)), "cell")
    own = F.pmod(F.xxhash64("node", "name"), F.when(F.col("member"), F.col("members_parts")).otherwise(F.col("queries_parts")))
    dealt = dealt.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), F.when(F.col("member"), F.col("queries_parts")).otherwise(F.col("members_parts")) - 1)))
    i, j = F.when(F.col("member"), F.col("own")).otherwise(F.col("met")), F.when(F.col("member"), F.col("met")).otherwise(F.col("own"))
    key = F.col("cell") * (1 << 40) + i * (1 << 20) + j
    dealt = dealt.select(key.alias("block"), "member", "node", "name", "weight", "home", "far", "vector")
    links = dealt.repartition("block").sortWithinPartitions("block").mapInArrow(_linked(shared, dim, threshold), "node long, name long, root long, links long")
    links = stored(links, "vector-links")

    roots = smallest_reachable(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node", "name").agg(F.sum("links").alias("links"))
    of_class = classes.join(counts, ["node", "name"], "left").join(roots, "node", "left")
    of_class = of_class.select("name", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    return named.select("vec_id", "name").join(of_class, "name").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
