"""Jaccard join of documents on five-word shingles by chosen paths.

A set's path starts at a run's number; each step picks the shingle that is least under a hash seeded by the path so
far. Two sets of similarity t take the same step with probability t, so after d steps they are in one bucket with
probability t**d, and runs are repeated until the target recall is met. Buckets split until they hold a few sets,
at most ``DEPTHS[-1]`` steps deep; sets of a bucket are then compared exactly. Buckets that even the last step left
large (many different texts that are near copies) are compared block by block.

Documents with equal sets are one class, which one of them stands for. A pair that meets in several runs is counted
in the first. Within a bucket links are counted and reduced to a spanning forest there and then, so a bucket gives a
row for each set, never one for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm import tables
from tidewheel.llm.components import smallest_reachable
from tidewheel.llm.hashing import Chunk, chunks, mix
from tidewheel.llm.tables import stored, with_fact

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.9999
#: Steps after which buckets are looked at; a bucket larger than BUCKET sets goes on to the next.
DEPTHS = (2, 3)
BUCKET = 256
#: Cells of the 0/1 matrix of sets by shingles that is multiplied at a time.
CELLS = 1 << 23


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """Runs after which a pair at ``similarity`` has met with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def _sets(chunk: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted within it, and where each text's begin; a text of fewer than k words is one shingle."""
    starts, grams = chunk.grams(k)
    rows = np.searchsorted(chunk.bounds, starts, "right") - 1
    n = np.diff(chunk.bounds)
    short = np.flatnonzero((n > 0) & (n < k))
    grams = np.concatenate((grams, chunk.runs(chunk.bounds[short], chunk.bounds[short + 1])))
    rows = np.concatenate((rows, short))
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    grams, rows = grams[new], rows[new]
    return grams, np.searchsorted(rows, np.arange(chunk.rows + 1))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _described(k: int, runs: int, depths: tuple[int, ...]) -> Callable:
    """For each text with words: two sums that name its set, the size of the set, and a key for each run and depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), plain=True):
                grams, bounds = _sets(chunk, k)
                rows = np.flatnonzero(np.diff(bounds))
                if not len(rows):
                    continue
                at, size = bounds[rows], np.diff(bounds)[rows]
                name = np.add.reduceat(mix(grams ^ np.uint64(0xA0761D6478BD642F)), at)
                other = np.add.reduceat(mix(grams ^ np.uint64(0xE7037ED1A0B428DB)), at)
                keys = np.zeros((len(rows), runs, len(depths)), np.uint64)
                for r in range(runs):
                    path = np.full(len(rows), mix(np.array([r + 1], np.uint64))[0])
                    for step in range(1, depths[-1] + 1):
                        least = np.minimum.reduceat(grams * np.repeat(path | np.uint64(1), size), at)
                        path = mix(path ^ least)
                        if step in depths:
                            keys[:, r, depths.index(step)] = path
                ids = batch.column("doc_id").take(pa.array(chunk.first + rows))
                lists = pa.FixedSizeListArray.from_arrays(_signed(keys.reshape(-1)), runs * len(depths)).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, _signed(name), _signed(other), pa.array(size.astype(np.int32)), lists], ["doc_id", "name", "other", "size", "keys"])

    return run


def _shingles(k: int) -> Callable:
    """For each text its set as sorted 32-bit hashes; of two shingles with equal hashes one is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), plain=True):
                grams, bounds = _sets(chunk, k)
                rows = np.flatnonzero(np.diff(bounds))
                if not len(rows):
                    continue
                name = np.add.reduceat(mix(grams ^ np.uint64(0xA0761D6478BD642F)), bounds[rows])
                sets = [np.unique((grams[bounds[i] : bounds[i + 1]] >> np.uint64(32)).astype(np.uint32)).tobytes() for i in rows.tolist()]
                ids = batch.column("doc_id").take(pa.array(chunk.first + rows))
                yield pa.RecordBatch.from_arrays([ids, _signed(name), pa.array(sets, pa.binary())], ["doc_id", "name", "shingles"])

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share, as a matrix, by products of 0/1 matrices."""
    m = len(sets)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    width = max(1, CELLS // m)
    common = np.zeros((m, m), np.float32)
    if column.size and column.max() >= width:
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        cuts = np.searchsorted(column, np.arange(0, column.max() + 1 + width, width))
    else:
        cuts = np.array([0, len(row)])
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if b > a:
            x = np.zeros((m, min(width, int(column[a:b].max()) + 1 - i * width)), np.float32)
            x[row[a:b], column[a:b] - i * width] = 1
            common += x @ x.T
    return common


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the edges a-b connect it with."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of rows with equal keys that follow each other, also across batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _new_pairs(table: pa.Table, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which two rows of a bucket may be linked and didn't meet in an earlier run."""
    run = table.column("run")[0].as_py()
    size = table.column("size").to_numpy()
    part = table.column("part").to_numpy()
    earlier = table.column("leaves").combine_chunks().flatten().to_numpy().reshape(len(size), -1)[:, :run]
    a, b = np.triu_indices(len(size), 1)
    fit = (np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b])) & ((part[a] != part[b]) | (table.column("same")[0].as_py()))
    name, node = table.column("name").to_numpy(), table.column("node").to_numpy()
    fit &= name[a] != name[b]
    a, b = a[fit], b[fit]
    met = np.zeros(len(a), bool)
    for r in range(earlier.shape[1]):
        met |= (earlier[a, r] == earlier[b, r]) & (earlier[a, r] != 0)
    return a[~met], b[~met], node


def _needed(similarity: float) -> Callable:
    """The rows of buckets that are part of a pair worth comparing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "block"):
            a, b, _ = _new_pairs(table, similarity)
            if len(a):
                yield from table.take(pa.array(np.unique(np.concatenate((a, b))))).combine_chunks().to_batches()

    return run


def _linked(similarity: float) -> Callable:
    """For each row of a bucket with links: how many documents they lead to, and the least node of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "block"):
            a, b, node = _new_pairs(table, similarity)
            if not len(a):
                continue
            sets = [np.frombuffer(x, np.uint32) for x in table.column("shingles").to_pylist()]
            size = np.array([len(s) for s in sets])
            common = common_counts(sets)[a, b]
            hit = common >= similarity * (size[a] + size[b] - common) - 1e-6
            a, b = a[hit], b[hit]
            if not len(a):
                continue
            weight, n = table.column("weight").to_numpy(), len(node)
            links = np.bincount(a, weight[b], n) + np.bincount(b, weight[a], n)
            order = np.argsort(node, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            root = node[order][forest(n, rank[a], rank[b])][rank]
            some = np.flatnonzero(links)
            name = table.column("name").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(name[some]), pa.array(root[some]), pa.array(links[some].astype(np.int64))], ["node", "name", "root", "links"])

    return run


def _buckets(paths: DataFrame, runs: int, depths: tuple[int, ...], bucket: int, rows: int) -> DataFrame:
    """(node, name, size, weight, run, leaf, held): the bucket each set ended in, by run, if another set is in it too.

    ``rows`` is at least the number of sets; how much the buckets of more than ``runs * rows / HEAVY`` sets hold is
    broadcast, so their rows stay dealt over tasks.
    """
    heavy = F.col("held") > max(bucket, runs * rows // tables.HEAVY)
    flat = paths.select("node", "name", "size", "weight", F.posexplode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run", "_"), "keys")
    keys = [F.element_at("keys", F.col("run") * len(depths) + i + 1).alias(f"k{i}") for i in range(len(depths))]
    alive = flat.select("node", "name", "size", "weight", "run", *keys)
    leaves = None
    for i in range(len(depths)):
        count = alive.groupBy(f"k{i}").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
        found = with_fact(alive, count, f"k{i}", "held", heavy, "node", "name")
        last = i == len(depths) - 1
        if not last:
            found = stored(found, "buckets")
        here = found if last else found.where(F.col("held") <= bucket)
        here = here.select("node", "name", "size", "weight", "run", F.col(f"k{i}").alias("leaf"), "held")
        leaves = here if leaves is None else leaves.union(here)
        alive = found.where(F.col("held") > bucket).drop("held")
    return leaves


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, recall: float = RECALL, bucket: int = BUCKET) -> DataFrame:
    """One row for each row of ``documents``: doc_id, copy_id, n_links, class_id (all long).

    Two documents are linked if the sets of their ``shingle``-word runs (lower-case ASCII letters, digits and all
    beyond ASCII make words; a text of fewer words is one run) have a Jaccard similarity of at least ``similarity``.
    copy_id is the smallest doc_id with the same set, n_links the number of other rows linked with this one,
    class_id the smallest doc_id reachable by links, itself included.

    A text without words (or null) has no links, nor has a row without doc_id (its ids are null). Rows that repeat a
    doc_id are linked if their texts are. Other columns are not looked at. An empty table gives an empty table.
    """
    runs = runs_for(recall, similarity, DEPTHS[-1])
    texts = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = stored(texts.mapInArrow(_described(shingle, runs, DEPTHS), "doc_id long, name long, other long, size int, keys array<long>"), "sets")
    classes = described.groupBy("name", "other").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    firsts = described.withColumnRenamed("doc_id", "node").dropDuplicates(["node", "name", "other"])
    paths = firsts.join(classes, ["name", "other", "node"])
    leaves = stored(_buckets(paths, runs, DEPTHS, bucket, described.count()), "leaves")

    # what a set ended in, run by run, goes with it into each bucket
    ends = F.map_from_entries(F.collect_list(F.struct("run", "leaf")))
    ends = leaves.groupBy("node", "name").agg(ends.alias("ends"))
    listed = F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.coalesce(F.col("ends")[r], F.lit(0)))
    members = leaves.join(ends, ["node", "name"]).withColumn("leaves", listed).drop("ends")
    # a large bucket is compared in blocks: its sets are dealt to parts, and each two parts meet
    parts = F.ceil(F.col("held") / bucket).cast("int")
    part = F.when(parts > 1, F.pmod(F.xxhash64("node", "name"), parts)).otherwise(0).cast("int")
    meets = F.transform(F.sequence(F.lit(0), parts - 1), lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j")))
    members = members.withColumn("part", part).withColumn("meets", F.explode(meets))
    members = members.select("node", "name", "size", "weight", "run", "leaves", "part", F.xxhash64("leaf", "meets").alias("block"), F.expr("meets.i = meets.j").alias("same"))
    needed = members.repartition("block").sortWithinPartitions("block").mapInArrow(_needed(similarity), members.schema)
    sets = texts.mapInArrow(_shingles(shingle), "doc_id long, name long, shingles binary").withColumnRenamed("doc_id", "node")
    full = needed.join(sets.dropDuplicates(["node", "name"]), ["node", "name"])  # rows may repeat
    links = full.repartition("block").sortWithinPartitions("block").mapInArrow(_linked(similarity), "node long, name long, root long, links long")
    links = stored(links, "links")

    roots = smallest_reachable(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node", "name").agg(F.sum("links").alias("links"))
    of_class = classes.join(counts, ["node", "name"], "left").join(roots, "node", "left")
    of_class = of_class.select("name", "other", "node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("class_id"))
    known = described.select("doc_id", "name", "other").join(of_class, ["name", "other"]).select("doc_id", F.col("node").alias("copy_id"), "n_links", "class_id")
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]").alias("words"))
    alone = plain.where("doc_id IS NULL OR NOT words").select("doc_id", F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"))
    return known.union(alone)
