"""Words, lines, records, files and sinks: golden fixtures and edge cases."""

import time
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel import sinks, sources
from tidewheel.functions import location_sentence, records_to_json
from tidewheel.operators import (
    count_by,
    latest_by_key,
    lines_starting_with,
    parse_json,
    parse_locations,
    partition_by_key,
    rebalance,
    split_words,
    tokenize,
    tumbling,
    tumbling_last,
)
from tidewheel.functions.text import plain_words
from tidewheel.plans import jobs
from tidewheel.storage import new_folder, shared_root
from tidewheel.streaming import append_to_table

LINES = ["red Kite, red", "blue kite", "RED boat", "a kite and a boat", "snow"]
LOCATIONS = [
    'p7:{"patientId": "p7", "lat": 10.25, "lon": 20.5}',
    'p8:{"patientId": "p8", "lat": -4.0, "lon": 0.125}',
    'p7:{"patientId": "p7", "lat": 10.5, "lon": 20.75}',
]


def lines(spark, values):
    return sources.rows_of(spark, values)


def values(df, column="value"):
    return [r[column] for r in df.collect()]


# --- words ---


@pytest.mark.parametrize(
    "line, normalised, plain",
    [
        ("", [], [""]),
        ("   ", [], []),
        ("  a b ", ["a", "b"], ["", "a", "b"]),
        ("Don't, stop!", ["dont", "stop"], ["Don't,", "stop!"]),
        ("café déjà", ["caf", "dj"], ["café", "déjà"]),
        ("a-b\tC\r\nd", ["ab", "c", "d"], ["a-b", "C", "d"]),
        ("-- !", [], ["--", "!"]),
        (" ", [], []),
        ("x", ["x"], ["x"]),
        ("日本 1", ["1"], ["日本", "1"]),
        ("a b", ["ab"], ["a b"]),  # a no-break space is no white space here
        ("a\x0bb", ["a", "b"], ["a", "b"]),
        (None, [], []),
    ],
)
def test_words_of_a_line(spark, line, normalised, plain):
    df = spark.createDataFrame([(line,)], "value string")
    assert values(tokenize(df), "word") == normalised
    assert values(split_words(df), "word") == plain


def test_words_like_a_loop_would_find_them(spark):
    """Random lines against the rules spelled out one character class at a time."""
    rng, space = random.Random(3), " \t\n\r\f\x0b"
    pool = "aZ09é-'.ß" + space * 2
    data = ["".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(3000)]

    def plain(line):
        words, word, in_space = [], "", False
        for c in line:
            if c in space:
                if not in_space:
                    words.append(word)
                word, in_space = "", True
            else:
                word, in_space = word + c, False
        words.append(word)
        if words == [""]:
            return words
        while words and words[-1] == "":
            words.pop()
        return words

    def normalised(line):
        kept = ["".join(c for c in w.lower() if c in "abcdefghijklmnopqrstuvwxyz0123456789") for w in plain(line)]
        return [w for w in kept if w]

    df = spark.createDataFrame(list(enumerate(data)), "i int, value string")
    for tokens, rule in [(tokenize, normalised), (split_words, plain)]:
        got = Counter(values(tokens(df), "word"))
        assert got == Counter(w for line in data for w in rule(line))


def test_word_counts(spark, tmp_path):
    (tmp_path / "input.txt").write_text("\n".join(LINES))
    df = sources.read_lines(spark, str(tmp_path / "input.txt"))
    assert values(df) == LINES
    counts = {r["word"]: r["cnt"] for r in jobs.word_count(df).collect()}
    assert counts == {"red": 3, "kite": 3, "blue": 1, "boat": 2, "a": 2, "and": 1, "snow": 1}
    plain = {r["word"]: r["cnt"] for r in jobs.plain_word_count(df).collect()}
    assert plain == {"red": 2, "Kite,": 1, "blue": 1, "kite": 2, "RED": 1, "boat": 2, "a": 2, "and": 1, "snow": 1}
    assert jobs.prefix_line_count(df).collect() == []


def test_word_count_combines_before_its_one_shuffle(spark):
    plan = jobs.word_count(lines(spark, LINES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("partial_count") > plan.index("Exchange")  # below it, so before it
    assert "Python" not in plan


def test_row_maps(spark):
    assert values(jobs.hello(spark, ["Red", "kite 9", "x"])) == [
        "RED", "KITE 9", "X",
    ]
    letters = lines(spark, list("abcdefgh"))
    expected = [f"[{c}] => {c.upper()}" for c in "abcdefgh"]
    assert values(jobs.letters(letters)) == expected
    assert sorted(values(jobs.letters(letters, partitions=5))) == expected


def test_row_count_contract(spark):
    df = lines(spark, LINES)
    assert jobs.letters(df).count() == len(LINES)  # map: one to one
    assert split_words(df).count() == 13  # flat map: one to many
    assert lines_starting_with(df, "b").count() == 1  # filter: none or one


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    lines(spark, ["Nn", "Nn", "nothing", "Na"]).write.parquet(path)
    df = jobs.prefix_line_count(spark.read.parquet(path))
    assert sorted((r["value"], r["cnt"]) for r in df.collect()) == [("Na", 1), ("Nn", 2)]
    assert "StringStartsWith(value,N)" in df._jdf.queryExecution().executedPlan().toString()


# --- sources ---


def test_sequence_includes_both_ends(spark):
    assert values(sources.sequence(spark, 1, 10, 3), "n") == list(range(1, 11))


@pytest.mark.parametrize("parts", [1, 4, 20])
def test_custom_source(spark, parts):
    name = sources.register_sequence_source(spark)
    df = spark.read.format(name).options(**{"from": 3, "to": 12, "partitions": parts}).load()
    assert df.rdd.getNumPartitions() == min(parts, 10)
    assert values(df, "n") == list(range(3, 13))


def test_empty_collection_is_refused(spark):
    with pytest.raises(ValueError):
        sources.rows_of(spark, [])


def test_keyed_lines_cut_at_the_first_separator(spark):
    out = sources.keyed_lines(lines(spark, [*LOCATIONS, "none", ":x", "k:"])).collect()
    assert out[0]["value"] == '{"patientId": "p7", "lat": 10.25, "lon": 20.5}'
    assert [r["key"] for r in out] == ["p7", "p8", "p7", None, "", "k"]
    assert [r["value"] for r in out[3:]] == ["none", "x", ""]
    arrow = sources.keyed_lines(lines(spark, ["a=>b=>c"]), separator="=>").first()
    assert (arrow["key"], arrow["value"]) == ("a", "b=>c")


def test_csv_rows_and_bad_rows(spark, tmp_path):
    (tmp_path / "p.csv").write_text("0,20,Duke\nx,notint,B\n2,22,Superman\n")
    df = sources.read_csv(spark, str(tmp_path), jobs.PERSON)
    assert sorted((r["id"], r["age"], r["name"]) for r in df.collect() if r["age"]) == [
        ("0", 20, "Duke"), ("2", 22, "Superman"),
    ]
    assert [r["age"] for r in df.collect() if r["id"] == "x"] == [None]
    good, bad = sources.split_corrupt(sources.read_csv(spark, str(tmp_path), jobs.PERSON, keep_corrupt=True))
    assert good.columns == ["id", "age", "name"]
    assert sorted(r["id"] for r in good.collect()) == ["0", "2"]
    assert values(bad, "_corrupt_record") == ["x,notint,B"]
    streamed = append_to_table(
        lambda: sources.watch_csv(spark, str(tmp_path), jobs.PERSON, keep_corrupt=True), spark
    )
    assert sources.split_corrupt(streamed)[1].count() == 1
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_csv(spark, str(tmp_path), jobs.PERSON, mode="FAILFAST").collect()


def test_topic_options():
    assert sources.topic_options("h:9092", "t") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "latest",
    }
    full = sources.topic_options("h:9092", "t", "g", "earliest", 1000, 64)
    assert full["kafka.group.id"] == "g" and full["startingOffsets"] == "earliest"
    assert full["maxOffsetsPerTrigger"] == "1000" and full["minPartitions"] == "64"


def test_topics_need_only_the_connector(spark):
    from pyspark.errors import AnalysisException

    for source in (sources.read_topic, sources.watch_topic):
        with pytest.raises(AnalysisException, match="kafka"):
            source(spark, "h:9092", "t")
    with pytest.raises(AnalysisException, match="kafka"):
        sinks.write_topic(lines(spark, ["x"]), "h:9092", "t")
    assert sinks.stream_to_topic(sources.rate_stream(spark), "h:9092", "t", "/nowhere") is not None


def test_generated_and_socket_sources_are_streams(spark):
    assert sources.rate_stream(spark, 5).isStreaming
    assert jobs.socket_upper(spark, "localhost", 9999).isStreaming  # nothing connects before the start
    assert jobs.socket_word_count(spark, "localhost", 9999, plain=True).columns == ["word", "cnt"]


# --- records ---


def test_location_lines(spark):
    messages = sources.keyed_lines(lines(spark, LOCATIONS)).drop("key")
    told, bad = jobs.location_lines(messages)
    assert values(told) == [
        "Patient p7 at location (10.25, 20.5)",
        "Patient p8 at location (-4.0, 0.125)",
        "Patient p7 at location (10.5, 20.75)",
    ]
    assert bad.count() == 0


def test_bad_locations(spark):
    texts = ['{"patientId": "1", "lat": "38.5", "lon": 1}', '{"patientId": 2, "lon": 1}', "{broken", None, "[1]"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    found, bad = parse_locations(df)
    assert [tuple(r) for r in found.collect()] == [("1", 38.5, 1.0), ("2", None, 1.0)]
    assert values(bad) == ["{broken", None, "[1]"]
    told, bad = jobs.location_lines(df)
    assert values(told) == ["Patient 1 at location (38.5, 1.0)"]
    assert sorted(map(str, values(bad))) == sorted(map(str, texts[1:]))  # nothing is lost
    with pytest.raises(Exception, match="MALFORMED"):
        jobs.location_lines(df, fail_fast=True)[0].collect()


def test_every_message_is_read_or_quarantined(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    texts = ['{"a":1,"b":"x"}', '{"a":"no"}', "", "{}", "null", '{"a":2}x', '{"b":null}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    good, bad = parse_json(df, schema)
    assert {r["i"]: tuple(r["record"]) for r in good.collect()} == {
        0: (1, "x"), 3: (None, None), 5: (2, None), 6: (None, None),  # what follows the object is not looked at
    }
    assert {r["i"]: r["value"] for r in bad.collect()} == {i: texts[i] for i in (1, 2, 4)}


def test_records_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([([(1, None), (2, "b")],)], "events array<struct<id:int,s:string>>")
    both = df.select(records_to_json(F.col("events")).alias("all"), records_to_json(F.col("events"), ["s"]).alias("s"))
    assert tuple(both.first()) == ('[{"id":1,"s":null},{"id":2,"s":"b"}]', '[{"s":null},{"s":"b"}]')


def test_latest_location(spark):
    data = [("123", 38.7167, 1), ("456", 41.1496, 2), ("123", 38.7170, 3), (None, 1.0, 4)]
    df = spark.createDataFrame(data, "id string, lat double, seq int")
    latest = latest_by_key(df, ["id"], ["seq"], ["lat"]).collect()
    assert {r["id"]: r["lat"] for r in latest} == {"123": 38.7170, "456": 41.1496, None: 1.0}
    both = latest_by_key(df, ["id"], ["seq", "lat"], ["lat", "seq"]).collect()
    assert {r["id"]: (r["lat"], r["seq"]) for r in both} == {"123": (38.7170, 3), "456": (41.1496, 2), None: (1.0, 4)}
    plan = latest_by_key(df, ["id"], ["seq"], ["lat"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_average_location(spark):
    data = [("1", 1.0, 0), ("1", 3.0, 299), ("1", 9.0, 300), ("2", 5.0, 10)]
    df = spark.createDataFrame(data, "patientId string, lat double, s int")
    df = df.select("patientId", "lat", (-F.col("lat")).alias("lon"), F.timestamp_seconds("s").alias("ts"))
    got = {(r["window_start"].minute, r["patientId"]): (r["lat"], r["lon"]) for r in jobs.average_location(df).collect()}
    assert got == {(0, "1"): (2.0, -2.0), (5, "1"): (9.0, -9.0), (0, "2"): (5.0, -5.0)}


def test_windows_sum_count_average_and_slide(spark):
    df = spark.range(1, 7).select(F.timestamp_seconds("id").alias("ts"), "id")
    aggs = [F.sum("id").alias("s"), F.count("*").alias("n"), F.avg("id").alias("m")]
    rows = tumbling(df, "3 seconds", aggs).orderBy("window_start").collect()
    assert [tuple(r)[2:] for r in rows] == [(3, 2, 1.5), (12, 3, 4.0), (6, 1, 6.0)]
    slid = tumbling(df, "4 seconds", [F.count("*").alias("n")], slide="2 seconds").orderBy("window_start").collect()
    assert [r["n"] for r in slid] == [1, 3, 4, 3, 1]


def test_window_bounds_are_those_of_sql(spark):
    data = [(None,), (-1,), (0,), (2_999,), (3_000,), (10**12 + 7,)]
    df = spark.createDataFrame(data, "ms bigint").select(F.timestamp_millis("ms").alias("ts"))
    own = tumbling(df, "3 seconds", [F.count("*").alias("n")])
    sql = df.groupBy(F.window("ts", "3 seconds").alias("w")).agg(F.count("*").alias("n"))
    sql = sql.select(F.col("w.start"), F.col("w.end"), "n")
    assert own.columns == ["window_start", "window_end", "n"]
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, sql.collect()))
    assert sum(r["n"] for r in own.collect()) == 5  # a row without time is in no window


# --- layout ---


def test_key_affinity(spark):
    df = spark.createDataFrame([(k, i) for i in range(100) for k in ("123", "456", "789")], "k string, i int")
    placed = partition_by_key(df, "k", partitions=6)
    assert placed.rdd.getNumPartitions() == 6
    places = placed.select("k", F.spark_partition_id().alias("p")).distinct()
    assert places.count() == 3


def test_rebalance_evens_out(spark):
    sizes = rebalance(spark.range(0, 1000, 1, 1), 5).groupBy(F.spark_partition_id()).count()
    assert [r["count"] for r in sizes.collect()] == [200] * 5


# --- sinks ---


def test_delimited_text(spark, tmp_path):
    df = spark.createDataFrame([("New York", 1), (None, 2)], "city string, cnt int")
    path = str(tmp_path / "out")
    sinks.write_delimited(df, path)
    assert sorted(values(spark.read.text(path))) == [" 2", "New York 1"]


def test_prefix_job_writes_counts(spark, tmp_path):
    path = str(tmp_path / "out")
    jobs.prefix_line_count_to_text(lines(spark, ["Nora is", "Nora is", "no"]), path)
    assert values(spark.read.text(path)) == ["Nora is 2"]


def test_collect_limited_and_print(spark, capfd):
    df = lines(spark, LINES)
    assert len(sinks.collect_limited(df, 2)) == 2
    assert len(sinks.collect_limited(df, 100)) == 5
    sinks.print_rows(df)
    assert all(line in capfd.readouterr().out for line in LINES[:1])
    sinks.print_rows(spark.range(100).selectExpr("id + 1000 AS id"))
    assert "1099" in capfd.readouterr().out


def test_topic_rows(spark):
    df = spark.createDataFrame([(7, "x")], "id bigint, body string")
    keyed = sinks.topic_rows(df, "body", "id")
    assert keyed.dtypes == [("key", "string"), ("value", "string")]
    assert sinks.topic_rows(df, F.upper("body")).first()["value"] == "X"


def test_each_batch_and_file_sinks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    seen = []
    stream = sources.watch_lines(spark, str(tmp_path))
    query = sinks.each_batch(stream, lambda b, i: seen.append((i, b.count())), new_folder(spark, "ck"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert seen == [(0, 2)]
    out = new_folder(spark, "out")
    writer = sinks.stream_to_files(stream, out, new_folder(spark, "ck"), "text")
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(values(spark.read.text(out))) == ["x", "y"]


def test_sentence_prints_doubles_like_java(spark):
    df = spark.range(1).select(location_sentence(F.lit("7"), F.lit(1e7), F.lit(0.001)).alias("s"))
    assert df.first()["s"] == "Patient 7 at location (1.0E7, 0.001)"


def test_count_by_several_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a")], "x int, y string")
    assert {tuple(r) for r in count_by(df, "x", "y").collect()} == {(1, "a", 2), (None, "a", 1)}


# --- storage ---


def test_shared_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_plain_words_take_linear_time(spark):
    text = "a" + " " * 1_000_000 + "b  "
    start = time.perf_counter()
    df = spark.createDataFrame([(text,), ("",), (" \t",), (" a b ",)], "t string").select(plain_words(F.col("t")).alias("w"))
    assert [r["w"] for r in df.collect()] == [["a", "b"], [""], [], ["", "a", "b"]]
    assert time.perf_counter() - start < 10


def test_words_keep_columns_and_position(spark):
    df = spark.createDataFrame([(7, "Ox, -- ox\tELK"), (8, " elk"), (9, None), (10, "")], "id long, value string")
    words = tokenize(df, keep=["id"], position="at")
    assert words.columns == ["id", "at", "word"]
    assert [tuple(r) for r in words.orderBy("id", "at").collect()] == [
        (7, 0, "ox"), (7, 2, "ox"), (7, 3, "elk"), (8, 1, "elk")
    ]
    plain = split_words(df, keep=["id"], position="at").orderBy("id", "at").collect()
    assert [tuple(r) for r in plain][:4] == [(7, 0, "Ox,"), (7, 1, "--"), (7, 2, "ox"), (7, 3, "ELK")]
    counted = jobs.running_word_count(df, ["id"]).orderBy("id", "position").collect()
    assert [r["cnt"] for r in counted] == [1, 2, 1, 2]
    with pytest.raises(ValueError, match="keep"):
        tokenize(df.withColumnRenamed("id", "word"), keep=["word"])


def test_time_and_number_sort_as_one(spark):
    import datetime as dt
    from itertools import product

    from tidewheel.functions.numbers import as_one_number

    times = [None, dt.datetime(1, 1, 2), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1),
             dt.datetime(2024, 2, 29, 1, 2, 3, 4), dt.datetime(9999, 12, 30)]
    pairs = list(product(times, [None, -(2**63), -1, 0, 2**63 - 1]))
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(pairs, f"t {kind}, n long")
        by_number = df.withColumn("x", as_one_number(df, ["t", "n"])).orderBy("x").collect()
        assert [(r["t"], r["n"]) for r in by_number] == pairs
        assert len({r["x"] for r in by_number}) == len(pairs)
    assert as_one_number(df, ["n", "t"]) is None


def test_last_of_a_window_is_not_sorted(spark):
    df = spark.createDataFrame([], "ts timestamp, id long, v double, name string")
    plan = tumbling_last(df, "1 hour", "v", ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan


def test_collect_stops_an_endless_stream(spark, tmp_path):
    """Files that come while the stream runs; it is stopped once there are enough rows."""
    import threading

    (tmp_path / "0.txt").write_text("a\nb\n")

    def drop():
        for i in (1, 2):
            time.sleep(1.5)
            part = tmp_path / f".{i}.part"
            part.write_text(f"c{i}\n")
            part.rename(tmp_path / f"{i}.txt")

    dropper = threading.Thread(target=drop)
    dropper.start()
    got = sinks.collect_limited(sources.watch_lines(spark, str(tmp_path)), 4)
    dropper.join()
    assert sorted(r["value"] for r in got) == ["a", "b", "c1", "c2"]
    assert not spark.streams.active
