"""Streams by micro-batch through the bounded operators: totals by changed keys, open windows carried, late rows."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_running import START, skewed_rows
from test_streaming import ROW, stream_of, write_in_order
from test_until import simulate, windows_of

from tidewheel.operators import interval_join, numbered_until, running_count, tokenize
from tidewheel.storage import new_folder
from tidewheel.streaming import (
    append_to_table,
    batches,
    forget,
    running_total_by_batch,
    running_total_rows,
    split_late_by_batch,
    start_running_total,
    windows_by_batch,
)
from tidewheel.streaming.totals import KeyedTotals

KEY = [T.StructField("k", T.StringType())]


@pytest.fixture(scope="module")
def rows():
    return sorted(skewed_rows(600, no_time=0.0), key=lambda r: (r[1], r[2]))


@pytest.fixture(scope="module")
def folder(spark, rows):
    return write_in_order(spark, rows, 4)


# --- totals by changed keys ---


def test_totals_are_those_of_changed_keys(spark):
    place = new_folder(spark, "totals")
    totals = KeyedTotals(place, KEY, ["n"], compact_every=3)
    want = {}
    for number in range(11):
        data = [(f"k{number % 4}", number), (None, 1), (None, 2)]
        added = totals.add(spark.createDataFrame(data, "k string, n long"), number)
        before = totals.before(spark, number)
        assert {r.k: r.n for r in (before.collect() if before else [])} == want
        assert {r.k: r.n for r in added.collect()} == {f"k{number % 4}": number, None: 3}
        again = totals.before(spark, number)  # as a retry would read it
        assert {r.k: r.n for r in (again.collect() if again else [])} == want
        for k, n in data:
            want[k] = want.get(k, 0) + n
    assert sorted(os.listdir(place)) == ["added-10", "added-6", "added-7", "added-8", "added-9", "base-6", "base-9"]


def test_a_restart_between_write_and_commit_changes_nothing(spark, monkeypatch):
    """The second micro-batch fails after all is written; started again it comes once more."""
    inbox, place = new_folder(spark, "in"), new_folder(spark, "out")
    for data in ([("a", 1), ("b", 2)], [("a", 3), (None, 4)], [("a", 5)]):
        spark.createDataFrame(data, "k string, i int").coalesce(1).write.mode("append").parquet(inbox)

    def run():
        build = lambda: stream_of(spark, inbox, "k string, i int")
        out = running_total_by_batch(build, spark, ["k"], ["i"], "cnt", folder=place)
        return sorted((r.k or "", r.i, r.cnt) for r in out.collect())

    start = batches._start

    def failing(stream, write, folder, every):
        def then_fail(batch, number):
            write(batch, number)
            if number == 1:
                raise RuntimeError("lost before the commit")

        return start(stream, then_fail, folder, every)

    monkeypatch.setattr(batches, "_start", failing)
    with pytest.raises(Exception, match="lost before the commit"):
        run()
    monkeypatch.setattr(batches, "_start", start)
    assert run() == [("", 4, 1), ("a", 1, 1), ("a", 3, 2), ("a", 5, 3), ("b", 2, 1)]
    forget(spark, place)
    assert not os.path.exists(place)


def test_a_running_word_count_of_an_endless_source(spark, tmp_path):
    inbox, place = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    lines = spark.readStream.schema("value string").text(str(inbox)).select("value", F.col("_metadata.file_name").alias("file"))
    words = tokenize(lines, "value", ["file"], "position")
    query = start_running_total(words, ["word"], ["file", "position"], "cnt", place, every="0 seconds")

    def counts(n):
        for _ in range(300):
            got = sorted((r.file, r.position, r.word, r.cnt) for r in running_total_rows(spark, place, words.schema, "cnt").collect())
            if len(got) >= n:
                return got
            time.sleep(0.2)
        raise AssertionError(got)

    try:
        (inbox / "1.txt").write_text("red kite red")
        first = [("1.txt", 0, "red", 1), ("1.txt", 1, "kite", 1), ("1.txt", 2, "red", 2)]
        assert counts(3) == first
        assert query.isActive
        (inbox / "2.txt").write_text("red boat")
        assert counts(5) == [*first, ("2.txt", 0, "red", 3), ("2.txt", 1, "boat", 1)]
        assert query.isActive
    finally:
        query.stop()


def test_a_micro_batch_is_dealt_to_more_tasks_than_the_state_has(spark, tmp_path):
    """before, as many tasks as the session has cores, whatever the number of rows."""
    spark.range(4000).selectExpr("id", "id % 400 AS k").write.parquet(str(tmp_path / "in"))
    place = str(tmp_path / "out")
    build = lambda: spark.readStream.schema("id long, k long").parquet(str(tmp_path / "in"))
    got = running_total_by_batch(build, spark, ["k"], ["id"], "cnt", folder=place, split_rows=50)
    assert sorted((r.id, r.cnt) for r in got.collect()) == [(i, i // 400 + 1) for i in range(4000)]
    files = [f for f in os.listdir(f"{place}/rows/__batch=0") if f.endswith(".parquet")]
    assert len(files) > 2 * spark.sparkContext.defaultParallelism


# --- open windows carried ---


def stream_windows(df):
    return windows_of(df)


@pytest.mark.parametrize("split_rows", [10**9, 40])
@pytest.mark.parametrize(("ends", "hand"), [({}, {}), ({"max_events": 4}, {"max_events": 4})])
def test_windows_carry_their_open_rows(spark, rows, folder, ends, hand, split_rows):
    done = windows_by_batch(lambda: stream_of(spark, folder), spark, ["k"], ["ts", "id"], "flag", split_rows=split_rows, **ends)
    assert done.columns == ["k", "ts", "id", "flag", "window_no"]
    assert windows_of(done) == simulate(rows, **hand)


@pytest.mark.parametrize("split_rows", [10**9, 40])
@pytest.mark.parametrize("seconds", [2000])
def test_timed_windows_by_batch(spark, rows, folder, seconds, split_rows):
    def build():
        return stream_of(spark, folder)

    every = simulate(rows, seconds=seconds)
    closed = windows_by_batch(build, spark, ["k"], ["ts", "id"], "flag", seconds=seconds, split_rows=split_rows, close=True)
    assert windows_of(closed) == every
    numbers = {}
    for r in closed.select("k", "window_no").distinct().collect():
        numbers.setdefault(r.k, []).append(r.window_no)
    assert all(sorted(v) == list(range(len(v))) for v in numbers.values())
    # without the end of the source only what time or a trigger has closed is out
    done = windows_of(windows_by_batch(build, spark, ["k"], ["ts", "id"], "flag", seconds=seconds, split_rows=split_rows))
    times, flagged = {r[2]: r[1] for r in rows}, {r[2] for r in rows if r[3]}
    latest = max(times.values())
    assert done == [w for w in every if w[1][-1] in flagged or times[w[1][0]] + dt.timedelta(seconds=seconds) <= latest]


def test_rows_without_a_time_by_batch(spark):
    at = [None if s is None else START + dt.timedelta(seconds=s) for s in (None, None, 0, 5, 20)]
    data = [("k", t, i, i == 0) for i, t in enumerate(at)]
    inbox = write_in_order(spark, data, 3)
    closed = windows_by_batch(lambda: stream_of(spark, inbox), spark, ["k"], ["ts", "id"], "flag", seconds=10, close=True)
    assert {r.id: r.window_no for r in closed.collect()} == {0: 0, 1: 1, 2: 2, 3: 2, 4: 3}


def test_an_empty_source_and_both_ends(spark, tmp_path):
    build = lambda: spark.readStream.schema(ROW).parquet(str(tmp_path))
    assert windows_by_batch(build, spark, ["k"], ["ts", "id"], "flag", seconds=5, close=True).count() == 0
    with pytest.raises(ValueError, match="not both"):
        numbered_until(spark.createDataFrame([], ROW), ["k"], ["ts", "id"], F.col("flag"), max_events=2, seconds=5)


# --- late rows ---


def test_late_and_kept_rows_are_all_rows(spark):
    def at(s):
        return None if s is None else START + dt.timedelta(seconds=s)

    files = [[(1, 100), (2, 40)], [(3, 89), (4, 90), (5, None), (6, 200)], [(7, 189), (8, 190), (9, 5)]]
    inbox = new_folder(spark, "late")
    for data in files:
        spark.createDataFrame([(i, at(s)) for i, s in data], "id int, ts timestamp").coalesce(1).write.mode("append").parquet(inbox)
    build = lambda: stream_of(spark, inbox, "id int, ts timestamp")
    kept, late = split_late_by_batch(build, spark, "ts", 10)
    assert sorted(r.id for r in late.collect()) == [3, 7, 9]
    assert sorted(r.id for r in kept.collect()) == [1, 2, 4, 5, 6, 8]
    assert kept.columns == late.columns == ["id", "ts"]


# --- interval joins ---

LEFT, RIGHT = "k string, lt timestamp, a int", "k string, rt timestamp, b int"


def sides(n=400, seed=2):
    import random

    rng = random.Random(seed)

    def some(m):
        out = []
        for i in range(m):
            k = "hot" if rng.random() < 0.4 else rng.choice([None, "a", "b", "c"])
            t = rng.choice([0, 0, rng.randrange(3000)]) if k == "hot" else rng.randrange(3000)
            out.append((k, None if rng.random() < 0.02 else START + dt.timedelta(milliseconds=t), i))
        return out

    return some(n), some(n)


def pairs_by_hand(left, right, lower, upper):
    low, high = dt.timedelta(milliseconds=lower), dt.timedelta(milliseconds=upper)
    return sorted((a[2], b[2]) for a in left for b in right if a[0] is not None and a[0] == b[0] and a[1] and b[1] and a[1] + low <= b[1] <= a[1] + high)


@pytest.mark.parametrize("split_rows", [100_000, 25])
@pytest.mark.parametrize(("lower", "upper"), [(0, 100), (10, 1500), (0, 0), (-300, -100)])
def test_interval_join(spark, lower, upper, split_rows):
    left, right = sides()
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    got = interval_join(a, b, ["k"], "lt", "rt", f"{lower} milliseconds", f"{upper} milliseconds", split_rows)
    assert got.columns == ["k", "lt", "a", "rt", "b"]
    assert sorted((r.a, r.b) for r in got.collect()) == pairs_by_hand(left, right, lower, upper)
    assert "Cartesian" not in (plan := got._jdf.queryExecution().toString()) and "NestedLoop" not in plan


def test_interval_join_refuses_what_it_cannot_do(spark):
    a, b = (spark.createDataFrame([], s) for s in (LEFT, RIGHT))
    for args in (("1 second", "0 seconds"), ("1 month", "2 months")):
        with pytest.raises(ValueError):
            interval_join(a, b, ["k"], "lt", "rt", *args)
    with pytest.raises(ValueError, match="both sides"):
        interval_join(a, a, ["k"], "lt", "lt", "0 seconds", "1 second")
    assert interval_join(a, b, ["k"], "lt", "rt", "0 seconds", "1 second").count() == 0


def test_streams_join_as_frames_do(spark):
    left, right = ([r for r in side if r[1]] for side in sides(200))
    a, b = (write_in_order(spark, sorted(side, key=lambda r: r[1]), 3, schema) for side, schema in ((left, LEFT), (right, RIGHT)))

    def build():
        timed = stream_of(spark, a, LEFT).withWatermark("lt", "1 second"), stream_of(spark, b, RIGHT).withWatermark("rt", "1 second")
        return interval_join(*timed, ["k"], "lt", "rt", "-50 milliseconds", "100 milliseconds")

    got = append_to_table(build, spark)
    assert sorted((r.a, r.b) for r in got.collect()) == pairs_by_hand(left, right, -50, 100)


def test_the_join_state_goes(spark):
    """Both watermarks pass: rows that can meet nothing any more leave the state."""
    times = [START + dt.timedelta(seconds=10 * i) for i in range(60)]
    a = write_in_order(spark, [("x", t, i) for i, t in enumerate(times)], 6, LEFT)
    b = write_in_order(spark, [("x", t, i) for i, t in enumerate(times)], 6, RIGHT)
    timed = stream_of(spark, a, LEFT).withWatermark("lt", "1 second"), stream_of(spark, b, RIGHT).withWatermark("rt", "1 second")
    joined = interval_join(*timed, ["k"], "lt", "rt", "0 seconds", "20 seconds")
    place = new_folder(spark, "joined")
    query = joined.writeStream.format("parquet").option("checkpointLocation", f"{place}/c").trigger(availableNow=True).start(f"{place}/rows")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) < 60 and spark.read.parquet(f"{place}/rows").count() == 60 + 59 + 58
