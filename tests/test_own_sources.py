"""A sink with a commit protocol and a stream reader with offsets, both on the data source API."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tidewheel.sinks.committed import CommittedWriter, committed_rows, register_committed_sink
from tidewheel.sources import read_table, stream_row_groups
from tidewheel.streaming import append_to_table
from test_streaming import stream_of

ROW = "i long, v string"
SCHEMA = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", T.StringType())])


def batch(*numbers):
    return pa.record_batch([pa.array(numbers, pa.int64()), pa.array([f"v{i}" for i in numbers])], names=["i", "v"])


def ids(spark, path):
    return sorted(r.i for r in committed_rows(spark, path, SCHEMA).collect())


def test_a_retried_and_an_aborted_micro_batch(spark, tmp_path):
    path = str(tmp_path / "out")
    writer = CommittedWriter(path)
    writer.commit([writer.write(iter([batch(1, 2), batch(3)])), writer.write(iter([])), writer.write(iter([batch(4)]))], 0)
    assert ids(spark, path) == [1, 2, 3, 4]
    writer.write(iter([batch(90)]))  # a task whose executor was lost: its file is in no manifest
    again = [writer.write(iter([batch(1, 2, 3, 4)]))]
    writer.commit(again, 0)
    lost = [writer.write(iter([batch(5)])), None]
    assert ids(spark, path) == [1, 2, 3, 4]
    writer.abort(lost, 1)
    writer.commit([writer.write(iter([batch(5, 6)]))], 1)
    assert ids(spark, path) == [1, 2, 3, 4, 5, 6]
    assert len(os.listdir(f"{path}/data")) == 2 + 1 + 1
    assert committed_rows(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_a_stream_whose_last_commit_was_lost_writes_once(spark, tmp_path):
    inbox, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for k in range(3):
        spark.createDataFrame([(i, f"v{i}") for i in range(10 * k, 10 * k + 10)], ROW).coalesce(2).write.mode("append").parquet(inbox)
    name = register_committed_sink(spark)

    def run():
        writer = stream_of(spark, inbox, ROW).writeStream.format(name).option("path", path)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    run()
    assert ids(spark, path) == list(range(30))
    numbers = sorted(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name_ in (f"{numbers[-1]}", f".{numbers[-1]}.crc"):  # as if the driver had gone between the sink's commit and Spark's
        os.remove(f"{checkpoint}/commits/{name_}")
    run()
    assert ids(spark, path) == list(range(30))
    manifests = [json.loads(line) for n in sorted(os.listdir(f"{path}/commits")) if n.endswith(".json") for line in open(f"{path}/commits/{n}")]
    assert sum(m["rows"] for m in manifests) == 30


def test_row_groups_as_a_stream(spark, tmp_path):
    """Equal to the bounded read; a restart takes what has come since, no more and no less."""
    import pyarrow.parquet as pq

    inbox, folder = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def put(name, numbers):
        pq.write_table(pa.Table.from_batches([batch(*numbers)]), inbox / f"{name}.parquet", row_group_size=4)

    def run():
        return sorted(r.i for r in append_to_table(lambda: stream_row_groups(spark, str(inbox), SCHEMA), spark, folder).collect())

    assert run() == []
    put("b", range(10))
    assert run() == list(range(10))
    assert run() == list(range(10))
    put("a", range(100, 109))  # a name before those already read
    put("c", range(10, 13))
    assert run() == [*range(13), *range(100, 109)]
    assert run() == sorted(r.i for r in spark.read.parquet(str(inbox)).collect())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_a_given_table_as_a_stream(spark):
    folder = "/root/testdata/sf0.001"
    want = read_table(spark, folder, "events").select("event_id", "event_type")
    got = append_to_table(lambda: stream_row_groups(spark, f"{folder}/events.parquet", want.schema), spark)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
