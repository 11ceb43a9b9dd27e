"""Streams: the same rows as the bounded form, state carried over micro-batches, lateness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_running import skewed_rows
from test_until import simulate, windows_of

from tidewheel import sinks, sources
from tidewheel.functions import fold_sequence
from tidewheel.operators import count_by, running_count, tumbling_last, with_event_time
from tidewheel.plans import jobs
from tidewheel.storage import new_folder
from tidewheel.streaming import (
    append_and_close,
    append_to_table,
    latest_to_table,
    running_count_stream,
    running_total_by_batch,
    windows_until_by_batch,
    windows_until_stream,
)

ROW = "k string, ts timestamp, id bigint, flag boolean"


def write_in_order(spark, rows, batches, schema=ROW):
    """Rows as parquet files of one micro-batch each (run with ``maxFilesPerTrigger=1``)."""
    folder = new_folder(spark, "in")
    size = -(-len(rows) // batches)
    for i in range(batches):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], schema)
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream_of(spark, folder, schema=ROW):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture(scope="module")
def rows():
    return sorted(skewed_rows(600, no_time=0.0), key=lambda r: (r[1], r[2]))


@pytest.fixture(scope="module")
def folder(spark, rows):
    return write_in_order(spark, rows, 3)


def stream_windows(df):
    got = {}
    for r in df.collect():
        got.setdefault((r["k"], r["window_no"]), []).append((r["place"], r["id"]))
    for places in got.values():
        assert sorted(p for p, _ in places) == list(range(len(places)))
    return sorted(((k, [i for _, i in sorted(v)]) for (k, _), v in got.items()), key=str)


def test_word_count_over_micro_batches(spark, tmp_path):
    lines = ["red kite", "red boat", "RED snow", "blue kite", "a b c"]
    for i, line in enumerate(lines):
        (tmp_path / f"{i}.txt").write_text(line)
    watched = latest_to_table(
        lambda: jobs.word_count(sources.watch_lines(spark, str(tmp_path), maxFilesPerTrigger=2)), spark, ["word"]
    )
    expected = {"red": 3, "kite": 2, "boat": 1, "snow": 1, "blue": 1, "a": 1, "b": 1, "c": 1}
    assert {r["word"]: r["cnt"] for r in watched.collect()} == expected
    bounded = jobs.word_count(sources.read_lines(spark, str(tmp_path)))
    assert {r["word"]: r["cnt"] for r in bounded.collect()} == expected


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    inbox, folder = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def run():
        lines = lambda: jobs.word_count(sources.watch_lines(spark, str(inbox)))
        return {r["word"]: r["cnt"] for r in latest_to_table(lines, spark, ["word"], folder).collect()}

    (inbox / "a.txt").write_text("red kite\nred boat\n")
    assert run() == {"red": 2, "kite": 1, "boat": 1}
    (inbox / "b.txt").write_text("red Snow\nBlue red\n")
    assert run() == {"red": 4, "kite": 1, "boat": 1, "snow": 1, "blue": 1}
    assert run() == {"red": 4, "kite": 1, "boat": 1, "snow": 1, "blue": 1}


def test_empty_source(spark, tmp_path):
    lines = lambda: sources.watch_lines(spark, str(tmp_path))
    assert append_to_table(lines, spark).count() == 0


def test_running_count_answers_every_record(spark, rows, folder):
    got = append_to_table(lambda: running_count_stream(stream_of(spark, folder), ["k"], ["ts", "id"]), spark)
    want = running_count(spark.createDataFrame(rows, ROW), ["k"], ["ts", "id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_until(spark, rows, folder):
    def build():
        return windows_until_stream(stream_of(spark, folder), ["k"], ["ts", "id"], F.col("flag"), ["ts", "id"])

    got = append_to_table(build, spark)
    assert stream_windows(got) == simulate(rows)
    assert dict(got.select("ts").dtypes) == {"ts": "timestamp"}
    assert {(r["id"], r["ts"]) for r in got.collect()} <= {(r[2], r[1]) for r in rows}


@pytest.mark.parametrize("split_rows", [10**9, 40])
def test_by_batch(spark, rows, folder, split_rows):
    def build():
        return stream_of(spark, folder)

    counted = running_total_by_batch(build, spark, ["k"], ["ts", "id"], "cnt", split_rows=split_rows)
    want = running_count(spark.createDataFrame(rows, ROW), ["k"], ["ts", "id"])
    assert sorted(map(str, counted.collect())) == sorted(map(str, want.collect()))
    done = windows_until_by_batch(build, spark, ["k"], ["ts", "id"], "flag", split_rows=split_rows)
    assert windows_of(done) == simulate(rows)


def test_by_batch_goes_on_from_the_checkpoint(spark):
    inbox, folder = new_folder(spark, "in"), new_folder(spark, "out")

    def run(*data):
        if data:
            spark.createDataFrame(data, "k string, i int").coalesce(1).write.mode("append").parquet(inbox)
        build = lambda: stream_of(spark, inbox, "k string, i int")
        out = running_total_by_batch(build, spark, ["k"], ["i"], "cnt", folder=folder)
        return sorted((r["k"] or "", r["i"], r["cnt"]) for r in out.collect())

    first = [("", 3, 1), ("a", 1, 1), ("a", 2, 2)]
    assert run(("a", 1), ("a", 2), (None, 3)) == first
    assert run() == first
    assert run(("a", 0), (None, 4)) == sorted([*first, ("a", 0, 3), ("", 4, 2)])
    assert run(("b", 9), ("a", 7))[-1] == ("b", 9, 1)


@pytest.mark.parametrize("cap", [1, 4])
def test_capped(spark, rows, folder, cap):
    def build():
        stream = stream_of(spark, folder)
        return windows_until_stream(stream, ["k"], ["ts", "id"], F.col("flag"), ["id"], max_events=cap)

    assert stream_windows(append_to_table(build, spark)) == simulate(rows, max_events=cap)


@pytest.mark.parametrize("seconds", [60, 2000])
def test_timeout(spark, rows, folder, seconds):
    """All windows whose time has run out by the last watermark are out, whichever of the next
    row and the timer closed them."""

    def build():
        stream = stream_of(spark, folder).withWatermark("ts", "0 seconds")
        return windows_until_stream(stream, ["k"], ["ts", "id"], F.col("flag"), ["id"], seconds=seconds)

    times = {r[2]: r[1] for r in rows}
    latest = max(times.values())
    got = stream_windows(append_to_table(build, spark))
    every = simulate(rows, seconds=seconds)
    closed = [w for w in every if times[w[1][0]] + dt.timedelta(seconds=seconds) < latest]
    flagged = {r[2] for r in rows if r[3]}
    closed_or_flagged = sorted(closed + [w for w in every if w not in closed and w[1][-1] in flagged], key=str)
    assert got == closed_or_flagged


def test_long_buffers_move_piecewise(spark, monkeypatch):
    data = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i, i == 24_999) for i in range(25_000)]
    folder = write_in_order(spark, data, 2)

    def build():
        return windows_until_stream(stream_of(spark, folder), ["k"], ["ts"], F.col("flag"), ["id"])

    assert stream_windows(append_to_table(build, spark)) == [("a", list(range(25_000)))]


# --- event-time windows ---

SEQ = "n bigint, v bigint"


def sequence_rows():
    return [(n, (n if n <= 5 else n - 5) * 1000) for n in range(1, 11)]


def test_sequence_windows_bounded_and_streamed(spark):
    numbers = sources.sequence(spark, 1, 10)
    out = jobs.sequence_windows(numbers, half=5).orderBy("window_start").collect()
    assert [r["message"] for r in out] == ["Window closed at event-time 2000", "Window closed at event-time 5000"]

    folder = new_folder(spark, "seq")
    numbers.coalesce(1).write.parquet(folder)
    streamed = lambda: jobs.sequence_windows(stream_of(spark, folder, "n bigint"), half=5)
    # append: a window comes out once the watermark (latest time minus delay) passes its end
    appended = append_to_table(streamed, spark).collect()
    assert [r["message"] for r in appended] == ["Window closed at event-time 2000"]
    # closed at the end of the source: all windows, and nothing of the row that closes them
    closed = append_and_close(
        lambda: stream_of(spark, folder, "n bigint").withColumn("ts", F.timestamp_millis(fold_sequence(F.col("n"), 5))),
        lambda rows: tumbling_last(rows.withWatermark("ts", "1 second"), "3 seconds", "n", ["ts", "n"]),
        spark,
        "ts",
    )
    assert {r["window_start"] for r in closed.collect()} == {r["window_start"] for r in out}
    # update: every window's latest value
    updated = latest_to_table(streamed, spark, ["window_start"]).orderBy("window_start").collect()
    assert [r["message"] for r in updated] == [r["message"] for r in out]


def test_late_rows(spark):
    """Rows up to the delay late count; rows of a window already closed do not."""

    def run(*batches):
        folder = new_folder(spark, "late")
        for batch in batches:
            spark.createDataFrame(batch, SEQ).coalesce(1).write.mode("append").parquet(folder)

        def build():
            timed = with_event_time(stream_of(spark, folder, SEQ), F.timestamp_millis("v"), "1 second")
            return tumbling_last(timed, "3 seconds", "v", ["v", "n"])

        return {r["window_start"].second: r["n"] for r in append_to_table(build, spark).collect()}

    on_time = [(1, 1000), (2, 2000), (3, 3500)]
    assert run(on_time, [(4, 2500)], [(5, 20000)], [(6, 30000)])[0] == 3  # watermark 2.5 s: still open
    assert run(on_time, [(4, 9000)], [(5, 9000)], [(6, 2500), (7, 30000)])[0] == 2  # closed long ago


def test_no_watermark_in_append_mode_is_refused(spark, folder):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        append_to_table(lambda: count_by(stream_of(spark, folder), "k"), spark)


# --- topics, on frames of the topic row schema ---


def topic_frame(spark, values):
    stamp = dt.datetime(2024, 1, 1)
    data = [
        (None if k is None else bytearray(k, "utf8"), bytearray(v, "utf8"), "t", p, o, stamp, 0) for k, v, p, o in values
    ]
    return spark.createDataFrame(data, sources.TOPIC_ROW)


def test_patient_windows_from_topic_to_topic(spark):
    def event(p, pos, s):
        return f'{{"patientId":"{p}","position":"{pos}","status":"{s}"}}'

    events = [("p1", "a", "NORMAL"), ("p2", "b", "NORMAL"), ("p1", "c", "X"), ("p1", "d", "NORMAL"),
              ("p2", "e", "X"), ("p2", "f", "X"), ("p1", "g", "NORMAL")]
    offsets, values = {}, []
    for e in events:
        p = int(e[0][1])
        offsets[p] = offsets.get(p, -1) + 1
        values.append((e[0], event(*e), p, offsets[p]))
    values.append(("p1", "no json", 1, 99))
    folder = new_folder(spark, "topic")
    for part in (values[:3], values[3:]):
        topic_frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
    messages = lambda: stream_of(spark, folder, sources.TOPIC_ROW)
    rows = append_to_table(lambda: jobs.patient_windows(messages())[0], spark)
    bad = append_to_table(lambda: jobs.patient_windows(messages())[1], spark)
    by_batch, unread = jobs.patient_windows_to_table(messages, spark)
    for told in (jobs.patient_window_messages(rows), jobs.patient_window_messages(by_batch, ["partition", "offset"])):
        assert sorted((r["key"], r["value"]) for r in told.collect()) == [
            ("p1", "[" + event("p1", "a", "NORMAL") + "," + event("p1", "c", "X") + "]"),
            ("p2", "[" + event("p2", "b", "NORMAL") + "," + event("p2", "e", "X") + "]"),
            ("p2", "[" + event("p2", "f", "X") + "]"),
        ]
    assert [tuple(r) for r in bad.collect()] == [tuple(r) for r in unread.collect()] == [(1, 99, "no json")]


def test_topic_to_topic_is_one_to_one(spark):
    frame = topic_frame(spark, [("k", "hello", 0, 0), (None, "straße", 0, 1)])
    out = jobs.topic_to_topic(frame)
    assert out.schema == T.StructType([T.StructField("value", T.StringType())])
    assert [r["value"] for r in out.collect()] == ["HELLO", "STRASSE"]


# --- watched folders ---


def test_watched_text_folder(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text("red kite\nred boat\n" if i % 2 == 0 else "red snow\nblue red\n")
    got = append_to_table(lambda: sources.watch_lines(spark, str(tmp_path)), spark).collect()
    assert len(got) == 6
    assert {r["value"] for r in got} == {"red kite", "red boat", "red snow", "blue red"}


def test_bytes_bound_a_micro_batch(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text("a\nb\n")
    sizes, lines = [], sources.watch_lines(spark, str(tmp_path), maxBytesPerTrigger="1")
    query = sinks.each_batch(lines, lambda b, _: sizes.append(b.count()), new_folder(spark, "ck"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert sizes == [2, 2, 2]


def test_watched_people(spark, tmp_path):
    names = ["Ada", "Ben", "Cleo", "Dov", "Ada"]
    for f in range(2):
        lines = [f"{i},{31 + 2 * i},{names[i % 5]}" for i in range(5 * f, 5 * f + 5)]
        (tmp_path / f"part-{f:03d}.csv").write_text("\n".join(lines) + "\n")
    got = append_to_table(lambda: jobs.watch_people(spark, str(tmp_path)), spark).collect()
    assert sorted((int(r["id"]), r["age"], r["name"]) for r in got) == [
        (i, 31 + 2 * i, names[i % 5]) for i in range(10)
    ]


def test_reserved_and_common_column_names(spark, tmp_path):
    rows = [(1, "a"), (2, "a"), (2, "b")]
    spark.createDataFrame(rows, "batch long, value string").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("batch long, value string").parquet(str(tmp_path / "in"))
    counted = latest_to_table(lambda: stream().groupBy("batch").count(), spark, ["batch"])
    assert sorted(map(tuple, counted.collect())) == [(1, 1), (2, 2)]
    with pytest.raises(ValueError, match="__batch"):
        latest_to_table(lambda: stream().groupBy(F.col("batch").alias("__batch")).count(), spark, ["__batch"])
