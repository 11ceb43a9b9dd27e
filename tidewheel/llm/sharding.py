"""Two-pass external shuffle of records into shards.

Pass 1 writes every record with the bucket that a seeded hash gives it; there are as many buckets as keep one within
``BUCKET_BYTES``. Pass 2 brings each bucket together, shuffles it in memory (Fisher-Yates, seeded by the bucket) and
numbers its records after those of the buckets before. Record number r goes to shard r mod n, slot r div n, so shards
hold equal numbers of rows, but for one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.jaccard import groups
from tidewheel.llm.tables import stored
from tidewheel.storage import new_folder

SHARDS, SEED, BUCKET_BYTES = 16, 20_240_229, 32 << 20
#: Bytes of a row besides its text, for the size of buckets.
ROW_BYTES = 256
#: Tasks of pass 2 at most; one takes its buckets one after another.
MAX_TASKS = 20_000


def _shuffled(seed: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "__bucket"):
            table = table.combine_chunks()
            bucket = table.column("__bucket")[0].as_py()
            order = np.random.Generator(np.random.PCG64([seed, bucket])).permutation(table.num_rows)
            table = table.take(pa.array(order))
            number = pa.array(table.column("__before")[0].as_py() + np.arange(table.num_rows))
            for batch in table.select(names).append_column("__number", number).combine_chunks().to_batches(max_chunksize=10_000):
                yield batch

    return run


def sharded(records: DataFrame, weight: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``records`` with ``shard`` (int) and ``slot`` (long, from 0 in each shard): a seeded random order, dealt in turn.

    ``weight`` is a column of bytes by which buckets are sized. Every row is placed, repeated rows each at their own
    slot; null ids are hashed like values. Columns named shard and slot are replaced. The same rows in the same files
    are placed alike each time; a retried task finds the buckets as pass 1 wrote them. No rows give no rows.
    """
    names = [c for c in records.columns if c not in ("shard", "slot")]
    row = records.select(F.sum(F.col(weight).cast("long")), F.count(F.lit(1))).first()
    buckets = max(1, -(-((row[0] or 0) + ROW_BYTES * row[1]) // bucket_bytes))
    # rows that are equal in all columns still part: their place in the scan is hashed too
    place = F.monotonically_increasing_id()
    dealt = records.select(*names, F.pmod(F.xxhash64(F.lit(seed), place), F.lit(buckets)).cast("int").alias("__bucket"), place.alias("__place"))
    dealt = stored(dealt, "scattered", compression="zstd")
    sizes = dealt.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("__bucket", (F.sum("n").over(Window.orderBy("__bucket")) - F.col("n")).alias("__before"))  # a row for each bucket
    placed = dealt.join(F.broadcast(before), "__bucket") if buckets <= 100_000 else dealt.join(before, "__bucket")
    tasks = min(buckets, MAX_TASKS)
    placed = placed.repartitionById(tasks, F.col("__bucket") % tasks).sortWithinPartitions("__bucket", "__place")
    schema = T.StructType([*[records.schema[c] for c in names], T.StructField("__number", T.LongType())])
    numbered = placed.mapInArrow(_shuffled(seed, names), schema)
    return numbered.select(*names, (F.col("__number") % shards).cast("int").alias("shard"), F.floor(F.col("__number") / shards).cast("long").alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """The rows of :func:`sharded` as Parquet, a folder for each shard; slots ascend within a file.

    Each task of pass 2 writes its own buckets, so the texts are not shuffled again.
    """
    placed.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)


def written(placed: DataFrame) -> DataFrame:
    """The rows of :func:`sharded`, written as shards to the shared folder and read again."""
    path = new_folder(placed.sparkSession, "llm-shards")
    write_shards(placed, path)
    return placed.sparkSession.read.schema(placed.schema).parquet(path).select(*placed.columns)
