"""What five filters remove, alone and together, in every order they could be applied.

Documents are reduced to the set of filters they fail, and these sets are counted by part. From them v(S), how many
documents at least one filter of S removes, is tabulated for all 32 sets S. The fair share of each filter is its
Shapley value, found as the least-squares fit of a sum of single shares to v: sets weighted by the Shapley kernel,
shares bound to add up to v(all), the normal equations solved in rationals. The counts of a step are differences
v(S + filter) - v(S), S being the filters before it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.tables import stored

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2  # the last two in hundredths
SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(0x41, 0x5B))
CONTINUED = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
ALL = (1 << len(FILTERS)) - 1
ROWS = 256
SHARE = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()  # bytes are split at 0x20 and 0x09 to 0x0D
    points = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    failed = len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT * len(words), 100 * capitals > MAX_CAPITALS * points, bool(SYMBOLS.search(text))
    return sum(f << i for i, f in enumerate(failed))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            texts = [t or b"" for t in rows.column("text").to_pylist()]
            failed, digests = [own_failures(t) for t in texts], [hashlib.sha256(t).digest() for t in texts]
            arrays = [rows.column("doc_id"), rows.column("part"), pa.array(digests, pa.binary()), pa.array(failed, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "part", "digest", "failed"])


def failures(documents: DataFrame) -> DataFrame:
    """(doc_id, part, failed, n): how many rows of a doc_id and part fail just the filters whose bits are set in ``failed``.

    A text fails E if a smaller doc_id has the same text. The smallest id of a text is looked up by text and id, so a
    text that a third of all rows share meets no single task.
    """
    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    docs = documents.select("doc_id", part, F.col("text").cast("binary").alias("text"))
    kinds = T.StructType([docs.schema["doc_id"], T.StructField("part", T.StringType()), T.StructField("digest", T.BinaryType()), T.StructField("failed", T.IntegerType())])
    rows = docs.mapInArrow(_judged, kinds).groupBy("doc_id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(rows, "audited")
    first = rows.where(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    numbered = rows.where(F.col("doc_id").isNotNull()).join(first, ["digest", "doc_id"], "left")
    copy = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    every = numbered.select("doc_id", "part", F.col("failed").bitwiseOR(copy).alias("failed"), "n")
    every = every.union(rows.where(F.col("doc_id").isNull()).select("doc_id", "part", "failed", "n"))
    return every.groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n"))


def shares(v: list[int]) -> list[Fraction]:
    """The Shapley value of each filter, ``v[S]`` being what the set S (as bits) removes; v of no filter is 0."""
    m = len(v).bit_length() - 1
    a = [[Fraction(0)] * m for _ in range(m)]
    b = [Fraction(0)] * m
    for s in range(1, len(v) - 1):
        size = s.bit_count()
        weight = Fraction(m - 1, comb(m, size) * size * (m - size))
        inside = [i for i in range(m) if s >> i & 1]
        for i in inside:
            b[i] += weight * v[s]
            for j in inside:
                a[i][j] += weight
    # minimise the weighted squares with the sum of shares fixed: a row and a column for the multiplier
    rows = [[*a[i], Fraction(1), b[i]] for i in range(m)] + [[*[Fraction(1)] * m, Fraction(0), Fraction(v[-1])]]
    for i in range(m + 1):
        pivot = next(r for r in range(i, m + 1) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(m + 1):
            if r != i and rows[r][i]:
                f = rows[r][i]
                rows[r] = [x - f * y for x, y in zip(rows[r], rows[i], strict=True)]
    return [rows[i][-1] for i in range(m)]


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """600 rows for each part from its tables of coalition removals."""
    names = [f.split()[0] for f in SHARE.split(", ")]
    m = len(FILTERS)
    orders = [("".join(FILTERS[i] for i in order), order) for order in permutations(range(m))]
    for batch in batches:
        for part in batch.to_pylist():
            v, good, toxic, total = part["removed"], part["good"], part["toxic"], part["total"]
            fair = [int(x * factorial(m)) for x in shares(v)]
            out = []
            for name, order in orders:
                before = 0
                for step, i in enumerate(order):
                    after, own = before | 1 << i, 1 << i
                    lost = v[after] - v[before]
                    out.append((part["part"], name, step + 1, total - v[after], lost, v[own] - lost, v[ALL] - v[ALL ^ own], good[after] - good[before], toxic[after] - toxic[before], fair[i]))
                    before = after
            kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _coalitions(n: Column) -> Column:
    """``n`` summed over what each set of filters removes, by the bits of the set."""
    return F.array(*[F.sum(F.when(F.col("failed").bitwiseAND(s) != 0, n).otherwise(0)) for s in range(ALL + 1)])


def audited(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step of it (1 to 5).

    part (a source; null and empty are one), filter_order, step, and counts of documents of the part: kept after this
    step, removed in it, redundant (failing its filter, removed before), unique_fails (failing its filter only),
    good_lost and toxic_lost (removed in it and labelled so), and shapley, the removed of its filter summed over all 120
    orders. Null texts count as empty, and empty texts are the same text. A row without a doc_id has no labels, never
    fails E and makes no other row fail it. Rows that repeat a doc_id are documents of their own with the labels of that
    id, and equal texts of one id don't make each other fail E. Labels that come twice count if one row says so. Extra
    columns are not looked at. No documents give no rows.
    """
    failed = failures(documents)
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("labelled"))
    marks = known.agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "is_good"), ("toxic", "is_toxic"))])
    rows = failed.join(marks, failed["doc_id"] == marks["labelled"], "left")
    counts = [F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(f"n_{c}") for c in ("is_good", "is_toxic")]]
    sets = rows.groupBy("part", "failed").agg(*counts)
    tables = [_coalitions(F.col(c)).alias(a) for c, a in (("n", "removed"), ("n_is_good", "good"), ("n_is_toxic", "toxic"))]
    return sets.groupBy("part").agg(F.sum("n").alias("total"), *tables).mapInArrow(_audited, SHARE)
