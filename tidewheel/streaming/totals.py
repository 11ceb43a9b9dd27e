"""A table of one total per key that a stream adds to, micro-batch by micro-batch.

What a micro-batch writes is what it adds, for the keys it has; a key that is quiet costs no
writing. Every :data:`COMPACT_EVERY` micro-batches the additions are summed up into a new base
and the files before the previous base go. Each micro-batch has a folder of its own, which a
retry overwrites, and reads only folders of earlier ones, so a failure between writing and
committing changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.storage import remove_folder

COMPACT_EVERY = 16


@dataclass(frozen=True)
class KeyedTotals:
    """Totals of the columns ``totals`` (longs) by ``keys``, under ``folder``."""

    folder: str
    keys: Sequence[T.StructField]
    totals: Sequence[str]
    compact_every: int = COMPACT_EVERY

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.keys, *[T.StructField(n, T.LongType()) for n in self.totals]])

    def _base(self, number: int) -> str:
        return f"{self.folder}/base-{number}"

    def _added(self, number: int) -> str:
        return f"{self.folder}/added-{number}"

    def _sum(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[k.name for k in self.keys]).agg(*[F.sum(n).alias(n) for n in self.totals])

    def _read(self, spark: SparkSession, *paths: str) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*paths)

    def before(self, spark: SparkSession, number: int) -> DataFrame | None:
        """The totals before micro-batch ``number``; None before the first. A missing folder is an error."""
        last = number - number % self.compact_every
        if number and number == last:
            earlier = last - self.compact_every
            paths = [*([self._base(earlier)] if earlier else []), *map(self._added, range(earlier, last))]
            self._sum(self._read(spark, *paths)).write.mode("overwrite").parquet(self._base(last))
            for old in range(max(0, earlier - self.compact_every), earlier):
                remove_folder(spark, self._added(old))
            if earlier - self.compact_every > 0:
                remove_folder(spark, self._base(earlier - self.compact_every))
        paths = [*([self._base(last)] if last else []), *map(self._added, range(last, number))]
        return self._sum(self._read(spark, *paths)) if paths else None

    def add(self, rows: DataFrame, number: int) -> DataFrame:
        """Write what micro-batch ``number`` adds, summed by key, and give it as read back."""
        self._sum(rows).write.mode("overwrite").parquet(self._added(number))
        return self._read(rows.sparkSession, self._added(number))


def of_these_keys(totals: DataFrame, some: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``totals`` whose key is in ``some`` (one row per key); null keys are equal."""
    names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    wanted = some.select(*[F.col(k).alias(n) for k, n in names.items()])
    return totals.join(wanted, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], "left_semi")
