"""Data-driven windows, bounded: fixtures, and random skewed input against record-by-record code."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_running import START, skewed_rows

from tidewheel.operators import gather_windows, windows_until, windows_until_capped, windows_until_timeout

SCHEMA = "k string, ts timestamp, id bigint, flag boolean"
SPLITS = [10**9, 40]


def simulate(rows, max_events=None, seconds=None):
    """[(key, [ids])] of the closed windows, by feeding records one at a time."""
    out, buffers = [], {}
    for k, ts, i, flag in sorted(rows, key=lambda r: (r[1], r[2])):
        buf = buffers.setdefault(k, [])
        if seconds and buf and ts >= buf[0][0] + dt.timedelta(seconds=seconds):
            out.append((k, [b[1] for b in buf]))
            buf.clear()
        buf.append((ts, i))
        if flag or len(buf) == max_events:
            out.append((k, [b[1] for b in buf]))
            buf.clear()
    if seconds:  # the input is whole: time runs out for what is left
        out += [(k, [b[1] for b in buf]) for k, buf in buffers.items() if buf]
    return sorted(out, key=str)


def windows_of(df, by=("window_no",)):
    rows = gather_windows(df, ["k"], ["ts", "id"], ["id"], by).collect()
    return sorted(((r["k"], [e["id"] for e in r["events"]]) for r in rows), key=str)


@pytest.fixture(scope="module", params=[0.0, 0.5])
def rows(request):
    return skewed_rows(no_time=0.0, same_time=request.param)


def test_patient_fixture(spark):
    data = [
        (1, "p1", "a", "NORMAL"), (2, "p2", "b", "NORMAL"), (3, "p1", "c", "X"), (4, "p1", "d", "NORMAL"),
        (5, "p2", "e", "X"), (6, "p2", "f", "X"), (7, "p1", "g", "NORMAL"),
    ]
    df = spark.createDataFrame(data, "seq bigint, patientId string, position string, status string")
    done = windows_until(df, ["patientId"], ["seq"], F.col("status") == "X")
    got = gather_windows(done, ["patientId"], ["seq"], ["position"]).collect()
    lists = sorted((r["patientId"], r["window_no"], [e["position"] for e in r["events"]]) for r in got)
    assert lists == [("p1", 0, ["a", "c"]), ("p2", 0, ["b", "e"]), ("p2", 1, ["f"])]


def test_null_status_is_no_trigger(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "X"), ("b", 3, None)], "k string, seq int, s string")
    done = windows_until(df, ["k"], ["seq"], F.col("s") == "X").collect()
    assert sorted((r["k"], r["seq"], r["window_no"]) for r in done) == [("a", 1, 0), ("a", 2, 0)]


@pytest.mark.parametrize("split_rows", SPLITS)
def test_until(spark, rows, split_rows):
    df = spark.createDataFrame(rows, SCHEMA)
    done = windows_until(df, ["k"], ["ts", "id"], F.col("flag"), split_rows)
    assert windows_of(done) == simulate(rows)


@pytest.mark.parametrize("split_rows", SPLITS)
@pytest.mark.parametrize("cap", [1, 3])
def test_capped(spark, rows, split_rows, cap):
    df = spark.createDataFrame(rows, SCHEMA)
    done = windows_until_capped(df, ["k"], ["ts", "id"], F.col("flag"), cap, split_rows)
    assert done.columns == ["k", "ts", "id", "flag", "window_no", "chunk"]
    assert windows_of(done, ("window_no", "chunk")) == simulate(rows, max_events=cap)


@pytest.mark.parametrize("split_rows", SPLITS)
@pytest.mark.parametrize("seconds", [1, 300])
def test_timeout(spark, rows, split_rows, seconds):
    df = spark.createDataFrame(rows, SCHEMA)
    done = windows_until_timeout(df, ["k"], "ts", ["id"], F.col("flag"), seconds, split_rows)
    assert windows_of(done) == simulate(rows, seconds=seconds)


@pytest.mark.parametrize("split_rows", SPLITS)
def test_timeout_of_rows_without_a_time(spark, split_rows):
    at = [None if s is None else START + dt.timedelta(seconds=s) for s in (None, None, None, 0, 5, 20)]
    data = [("k", t, i, i == 1) for i, t in enumerate(at)]
    df = spark.createDataFrame(data, SCHEMA)
    done = windows_until_timeout(df, ["k"], "ts", ["id"], F.col("flag"), 10, split_rows)
    assert {r["id"]: r["window_no"] for r in done.collect()} == {0: 0, 1: 0, 2: 1, 3: 2, 4: 2, 5: 3}


def test_timeout_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        data = skewed_rows(400, no_time=0.0)
        df = spark.createDataFrame(data, SCHEMA)
        done = windows_until_timeout(df, ["k"], "ts", ["id"], F.col("flag"), 2000)
        assert windows_of(done) == simulate(data, seconds=2000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_plain_form_shuffles_once(spark):
    df = spark.createDataFrame(skewed_rows(100, no_time=0.0), SCHEMA)
    capped = windows_until_capped(df, ["k"], ["ts", "id"], F.col("flag"), 3)
    for rows, by in [(windows_until(df, ["k"], ["ts", "id"], F.col("flag")), ()), (capped, ("chunk",))]:
        lists = gather_windows(rows, ["k"], ["ts", "id"], ["id"], ("window_no", *by))
        plan = lists._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Python" not in plan


def test_waiting_rows_are_dropped_before_the_lists(spark):
    """A key that never meets the condition must not be gathered only to be thrown away."""
    data = [("never", START + dt.timedelta(seconds=i), i, False) for i in range(2000)]
    df = spark.createDataFrame(data, SCHEMA)
    for split_rows in (10**9, 100):
        assert windows_until(df, ["k"], ["ts", "id"], F.col("flag"), split_rows).count() == 0


@pytest.mark.parametrize("millis", [1, 7, 50, 10**6])
@pytest.mark.parametrize("batch_rows", [1, 3, 1000])
def test_window_starts_over_batches(millis, batch_rows):
    import random

    import pyarrow as pa

    from tidewheel.operators.chains import _window_starts

    rng, rows = random.Random(millis), []
    for key in [None, "a", "b", "c"]:
        for stretch in range(3):
            times = sorted(rng.sample(range(300 if key == "a" else 5000), rng.randrange(1, 60)))
            rows += [(key, stretch, t) for t in times]
    want, group, last = [], None, None
    for key, stretch, t in rows:
        if (key, stretch) != group or t >= last + millis:
            want.append((key, stretch, t))
            group, last = (key, stretch), t
    schema = pa.schema([("k", pa.string()), ("s", pa.int64()), ("__ms", pa.int64())])
    table = pa.table(list(zip(*rows)), schema=schema)
    got = _window_starts(["k", "s"], millis)(iter(table.to_batches(batch_rows)))
    assert [tuple(r.values()) for b in got for r in b.to_pylist()] == want


# --- chains cut into slices ---

CHAIN = "k string, s long, at long, extra string"


def chain_by_hand(rows, step):
    out, last = [], {}
    for k, s, at, _ in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        if (k, s) not in last or at >= last[k, s] + step:
            last[k, s] = at
            out.append((k, s, at))
    return sorted(out, key=str)


@pytest.mark.parametrize("step", [9, 4000, 10**7])
@pytest.mark.parametrize("spread", [6_000, 10**6])
def test_chain_over_slices(spark, step, spread):
    import random

    rng = random.Random(step)
    times = rng.sample(range(spread), 3000)
    gap = [t if t < spread // 2 else t + 50_000 for t in times]  # a stretch without any value
    rows = [(None, 0, t, "x") for t in gap] + [("b", 1, t, "y") for t in times[:900]] + [("c", i, t, "z") for i in range(3) for t in times[:40]]
    rows.append((None, 0, -(1 << 62), "no time"))
    df = spark.createDataFrame(rows, CHAIN)
    from tidewheel.operators.chains import chain_starts

    for split_rows in (None, 200):
        got = chain_starts(df, ["k", "s"], "at", step, split_rows)
        assert got.columns == df.columns
        assert sorted(((r.k, r.s, r.at) for r in got.collect()), key=str) == chain_by_hand(rows, step)


def test_one_key_without_a_trigger_runs_in_many_tasks(spark):
    """A million distinct times of one key and no trigger: no task follows the chain alone."""
    from tidewheel.operators.chains import chain_starts

    at = F.col("id") * 7 + F.pmod(F.xxhash64("id"), F.lit(5))
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit("k").alias("k"), F.lit(0).cast("long").alias("s"), at.alias("at"))
    got = chain_starts(df, ["k", "s"], "at", 1000, split_rows=100_000)
    found = got.select("at", F.spark_partition_id().alias("task")).collect()
    want = []
    for time in sorted(r.at for r in df.collect()):
        if not want or time >= want[-1] + 1000:
            want.append(time)
    assert sorted(r.at for r in found) == want
    assert len({r.task for r in found}) > 1
