"""Where intermediate tables and stream checkpoints go: always a folder all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: tempfile.TemporaryDirectory | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the checkpoint folder of the session.

    Only a local session may go without that setting; it gets a temporary folder.
    On a cluster a machine-local folder would lose data with its machine, so there
    the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="tidewheel-")
    return _local_root.name


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared root that nothing has used before."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system Spark can write to; False if there was none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
