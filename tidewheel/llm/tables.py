"""Reading the input tables, tables written half-way in the folder the cluster shares, and joins with heavy keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.storage import new_folder


#: A key is heavy if it has more than 1 / HEAVY of all rows, so there are fewer than HEAVY such keys.
HEAVY = 16_384


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there.

    A lost executor then costs a read of these files, not the work before them.
    """
    path = new_folder(df.sparkSession, f"llm-{purpose}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_fact(rows: DataFrame, facts: DataFrame, key: str, fact: str, heavy: Column, *spread: str) -> DataFrame:
    """``rows`` with the column ``fact`` of their key; rows whose key has none are left out.

    ``facts`` has each ``key`` once. Those for which ``heavy`` holds are broadcast, so the caller bounds their number;
    the rows they belong to are dealt out by a hash of the columns ``spread``, so no task gets all rows of a key. The
    other facts meet their rows by a shuffle on the key.
    """
    hot = facts.where(heavy).select(F.col(key).alias("__hot"), F.col(fact).alias("__hot_fact"))
    cold = facts.where(~heavy).select(F.col(key).alias("__cold"), F.col(fact).alias("__cold_fact"))
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    # should the hash be another key, the fact that is known already still comes first
    met = met.withColumn("__dealt", F.when(F.col("__hot").isNull(), F.col(key)).otherwise(F.xxhash64(*spread)))
    met = met.join(cold, F.col("__dealt") == F.col("__cold"), "left")
    found = met.select(*rows.columns, F.coalesce("__hot_fact", "__cold_fact").alias(fact))
    return found.where(F.col(fact).isNotNull())
