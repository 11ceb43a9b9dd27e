"""User folds, row-count contracts, and the latest row of a key in a state that forgets."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from test_running import START, skewed_rows
from test_streaming import stream_of

from tidewheel.operators import RowContractBroken, latest_by_key, quoted_fields, reduce_by_key, with_row_contract
from tidewheel.storage import new_folder
from tidewheel.streaming import latest_by_key_stream, latest_to_table, stateful_settings

# --- user folds ---


def folds():
    """Functions that travel to the tasks by value: tasks can't import this module."""

    def joined(a, b):
        """Texts after one another: associative, and the order matters."""
        return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(a.column("t"), b.column("t"), "")], names=["t"])

    def added(a, b):
        """Sums with nulls as nothing: the order does not matter."""
        x, y = (pc.fill_null(r.column("n"), 0) for r in (a, b))
        return pa.RecordBatch.from_arrays([pc.add(x, y)], names=["n"])

    return joined, added


joined, added = folds()


@pytest.mark.parametrize("split_rows", [10**9, 100])
@pytest.mark.parametrize("batch_rows", [10_000, 7])
def test_a_fold_in_order(spark, split_rows, batch_rows):
    rows = skewed_rows(1200)
    df = spark.createDataFrame([(k, ts, i, f"{i},") for k, ts, i, _ in rows], "k string, ts timestamp, i long, t string").repartition(5)
    want = {}
    for k, _, i, _ in sorted(rows, key=lambda r: (r[1] or dt.datetime.min, r[2])):
        want[k] = want.get(k, "") + f"{i},"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        got = reduce_by_key(df, ["k"], ["t"], joined, ["ts", "i"], split_rows)
        assert got.columns == ["k", "t"]
        assert {r.k: r.t for r in got.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_fold_without_order_combines_before_the_shuffle(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, 1, 2, 3])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "k string, n long")
    got = reduce_by_key(df, ["k"], ["n"], added)
    want = {}
    for k, n in rows:
        want[k] = want.get(k, 0) + (n or 0)
    assert {r.k: r.n for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.rindex("Exchange") < plan.rindex("MapInArrow")  # the lowest is before any shuffle
    assert reduce_by_key(df.where("false"), ["k"], ["n"], added).count() == 0


# --- row contracts ---


def test_contracts_of_bounded_steps(spark):
    df = spark.range(100)
    for rule, step, counts in [
        ("1:1", lambda d: d.withColumn("x", F.col("id") * 2), (100, 100)),
        ("1:0..1", lambda d: d.where("id % 4 = 0"), (100, 25)),
        ("1:1..N", lambda d: d.select(F.explode(F.array("id", "id"))), (100, 200)),
        ("N:M", lambda d: d.groupBy(F.col("id") % 7).count(), (100, 7)),
    ]:
        out, contract = with_row_contract(df, step, "step", rule)
        out.write.format("noop").mode("overwrite").save()
        assert contract.check() == counts


def test_a_broken_map_is_caught(spark):
    out, contract = with_row_contract(spark.range(10), lambda d: d.where("id <> 3"), "map", "1:1")
    out.write.format("noop").mode("overwrite").save()
    with pytest.raises(RowContractBroken, match="map: 10 rows in, 9 rows out breaks 1:1"):
        contract.check()
    with pytest.raises(ValueError, match="no such rule"):
        with_row_contract(spark.range(1), lambda d: d, "map", "2:1")


def streamed(spark, *sizes):
    folder = new_folder(spark, "in")
    for n in sizes:
        spark.range(n).coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.mark.parametrize(("keep", "broken"), [("true", False), ("id <> 25", True)])
def test_contracts_of_streams(spark, keep, broken):
    """Micro-batches of 20, 30 and 10 rows; the broken map loses a row of the second."""
    folder = streamed(spark, 20, 30, 10)
    out, contract = with_row_contract(stream_of(spark, folder, "id long"), lambda d: d.where(keep), "map", "1:1")
    query = out.writeStream.format("noop").option("checkpointLocation", new_folder(spark, "ck")).trigger(availableNow=True).start()
    with contract.watch(query) as watch:
        if broken:
            with pytest.raises(RowContractBroken, match="30 rows in, 29 rows out breaks 1:1 in micro-batch 1"):
                watch.to_end()
        else:
            watch.to_end()
            assert contract.counted == [(20, 20), (30, 30), (10, 10)]


# --- the latest row of each key ---

ROW = "k string, ts timestamp, i long, v string"


def test_latest_by_key_stream_equals_the_bounded_form(spark):
    rows = [(k, ts, i, f"v{i}") for k, ts, i, _ in skewed_rows(500, no_time=0.0, same_time=0.3)]
    folder = new_folder(spark, "in")
    for a in range(0, 500, 180):
        spark.createDataFrame(rows[a : a + 180], ROW).coalesce(1).write.mode("append").parquet(folder)

    def build():
        return latest_by_key_stream(stream_of(spark, folder, ROW), ["k"], ["ts", "i"], ["v", "i"])

    got = latest_to_table(build, spark, ["k"])
    want = latest_by_key(spark.createDataFrame(rows, ROW), ["k"], ["ts", "i"], ["v", "i"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("quiet", [30.0, None])
def test_the_state_of_a_quiet_key_goes(spark, quiet):
    """Forty keys say something once, one goes on: with a time to live only its state is left."""
    inbox = new_folder(spark, "in")
    for data in ([(f"k{i}", i) for i in range(40)], [("on", 50)], [("on", 200)], [("on", 210), ("k3", 220)]):
        rows = [(k, START + dt.timedelta(seconds=s), s, "") for k, s in data]
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(inbox)
    with stateful_settings(spark):
        timed = stream_of(spark, inbox, ROW).withWatermark("ts", "0 seconds")
        writer = latest_by_key_stream(timed, ["k"], ["ts"], ["i"], quiet).writeStream.outputMode("update").format("noop")
        query = writer.option("checkpointLocation", new_folder(spark, "ck")).trigger(availableNow=True).start()
    assert query.awaitTermination(100)
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(held) >= 40
    assert (held[-1] < 10) == bool(quiet)


# --- quoted fields ---


def fields_by_hand(line, separator=":"):
    out, now, inside = [], "", False
    for c in line:
        if c == separator and not inside:
            out.append(now)
            now = ""
            continue
        inside ^= c == '"'
        now += c
    return [f[1:-1].replace('""', '"') if len(f) >= 2 and f[0] == f[-1] == '"' else f for f in [*out, now]]


def test_quoted_fields(spark):
    rng = random.Random(9)
    texts = ["", ":", "a:b", '"a:b":c', '"":"', '"say ""x:y"" now":é', None, "x"] + ["".join(rng.choice('ab:"é') for _ in range(rng.randrange(14))) for _ in range(300)]
    got = quoted_fields(spark.createDataFrame(list(enumerate(texts)), "n int, t string").repartition(3), "t", "n")
    assert got.columns == ["n", "position", "field"]
    want = [(n, i, f) for n, t in enumerate(texts) if t is not None for i, f in enumerate(fields_by_hand(t))]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert quoted_fields(spark.createDataFrame([], "n int, t string"), "t", "n").count() == 0
