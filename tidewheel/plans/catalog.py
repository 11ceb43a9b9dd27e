"""The registered queries: each operator over a whole table, with SQL that says the same.

``QUERIES[name](spark, folder)`` gives a frame; ``ORACLES[name]`` is SQL for another engine over
tables of the same names, with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel import sinks, sources
from tidewheel.functions import fold_sequence, location_sentence, records_to_json, show_upper, with_prefix
from tidewheel.operators import (
    count_by,
    flatten_valid,
    gather_windows,
    interval_join,
    latest_by_key,
    parse_flagged,
    parse_json,
    parse_locations,
    partition_by_key,
    quoted_fields,
    reduce_by_key,
    running_count,
    tumbling,
    tumbling_last,
    upper_lines,
    windows_until,
    windows_until_capped,
    windows_until_timeout,
    with_event_time,
)
from tidewheel.plans import jobs
from tidewheel.sources import read_table, stream_table
from tidewheel.storage import new_folder
from tidewheel.streaming import (
    append_and_close,
    append_to_table,
    latest_by_key_stream,
    latest_to_table,
    running_count_stream,
    running_total_by_batch,
    split_late_by_batch,
    windows_by_batch,
    windows_until_by_batch,
    windows_until_stream,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Bounds of a micro-batch over a stored table; the lower one where a key's rows of a micro-batch
# are sorted in the memory of one task (a row of events takes some 250 bytes there, and 20 in its
# file). A file is not divided, so this bounds a micro-batch to the limit or one file.
LIMITS = {"maxBytesPerTrigger": str(256 << 30)}
STATEFUL_LIMITS = {"maxBytesPerTrigger": str(32 << 20)}
PURCHASE = "event_type = 'purchase'"
IN_ORDER = ["ts", "event_id"]


def _share(df: DataFrame) -> int:
    """A twentieth of the rows: a key with more than that is cut, whatever the size of the table."""
    return max(1, df.count() // 20)


def query(oracle: str):
    """Register the decorated function under its name."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__], ORACLES[run.__name__] = run, oracle
        return run

    return register


def _ids(events: str = "events") -> Column:
    return F.concat_ws(",", F.transform(events, lambda e: e["event_id"].cast("string"))).alias("ids")


# --- words and lines ---

_WORD_COUNT = r"""
    SELECT word, count(*) AS cnt
    FROM (SELECT unnest(regexp_split_to_array(
              regexp_replace(lower(trim(text)), '[^a-z0-9\s]', '', 'g'), '\s+')) AS word
          FROM documents)
    WHERE word <> '' GROUP BY word"""


@query(_WORD_COUNT)
def word_count(spark, folder):
    return jobs.word_count(read_table(spark, folder, "documents"), "text")


@query(r"""
    SELECT word, count(*) AS cnt
    FROM (SELECT unnest(CASE WHEN regexp_full_match(text, '\s+') THEN []::VARCHAR[]
              ELSE regexp_split_to_array(regexp_replace(text, '\s+$', ''), '\s+') END) AS word
          FROM documents)
    GROUP BY word""")
def plain_split_count(spark, folder):
    return jobs.plain_word_count(read_table(spark, folder, "documents"), "text")


_RUNNING_WORDS = r"""
    WITH raw AS (SELECT doc_id, regexp_split_to_array(lower(text), '\s+') AS words FROM documents),
         each AS (SELECT doc_id, (generate_subscripts(words, 1) - 1)::INT AS position, unnest(words) AS word FROM raw),
         kept AS (SELECT doc_id, position, regexp_replace(word, '[^a-z0-9]', '', 'g') AS word FROM each)
    SELECT doc_id, position, word, row_number() OVER (PARTITION BY word ORDER BY doc_id, position) AS cnt
    FROM kept WHERE word <> ''"""


@query(_RUNNING_WORDS)
def running_word_count(spark, folder):
    return jobs.running_word_count(read_table(spark, folder, "documents"), ["doc_id"], "text")


@query("SELECT p_partkey, upper(p_name) AS p_name FROM part")
def upper_map(spark, folder):
    return upper_lines(read_table(spark, folder, "part").select("p_partkey", "p_name"), "p_name")


@query("SELECT c_custkey, '[' || c_name || '] => ' || upper(c_name) AS line FROM customer")
def format_map(spark, folder):
    customers = read_table(spark, folder, "customer")
    return customers.select("c_custkey", show_upper(F.col("c_name")).alias("line"))


@query("SELECT '[' || p_name || '] => ' || upper(p_name) AS p_name FROM part")
def rebalanced_letters(spark, folder):
    return jobs.letters(read_table(spark, folder, "part"), spark.sparkContext.defaultParallelism, "p_name")


@query("SELECT o_orderkey, 'Order number ' || o_orderkey AS line FROM orders")
def prefix_map(spark, folder):
    orders = read_table(spark, folder, "orders")
    return orders.select("o_orderkey", with_prefix("Order number ", F.col("o_orderkey")).alias("line"))


@query("""
    SELECT c_mktsegment, count(*) AS cnt FROM customer
    WHERE starts_with(c_mktsegment, 'M') GROUP BY c_mktsegment""")
def prefix_line_count(spark, folder):
    return jobs.prefix_line_count(read_table(spark, folder, "customer"), "M", "c_mktsegment")


# --- counts per key ---


@query("SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def final_count(spark, folder):
    return count_by(read_table(spark, folder, "events"), "event_type")


_RUNNING = """
    SELECT event_id, event_type, (sum(1) OVER (PARTITION BY event_type ORDER BY ts, event_id
        ROWS UNBOUNDED PRECEDING))::BIGINT AS cnt
    FROM events"""


def _events_to_count(spark, folder):
    return read_table(spark, folder, "events").select("event_id", "event_type", "ts")


@query(_RUNNING)
def running_count_per_record(spark, folder):
    return running_count(_events_to_count(spark, folder), ["event_type"], IN_ORDER).drop("ts")


@query(_RUNNING)
def running_count_hot_keys(spark, folder):
    """The same with every key of more than a twentieth of the rows cut into slices: five keys hold all rows."""
    events = _events_to_count(spark, folder)
    return running_count(events, ["event_type"], IN_ORDER, split_rows=_share(events)).drop("ts")


_LATEST_PER_KEY = """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
        arg_max(value, (ts, event_id)) AS value, max(ts) AS ts
    FROM events GROUP BY user_id"""


@query(_LATEST_PER_KEY)
def latest_per_key(spark, folder):
    return latest_by_key(read_table(spark, folder, "events"), ["user_id"], IN_ORDER, ["event_type", "value", "ts"])


def _best_run(a: pa.RecordBatch, b: pa.RecordBatch) -> pa.RecordBatch:
    """Merge of two stretches: total, best beginning, best end and best run of consecutive rows."""
    x, y = ({n: r.column(n) for n in a.schema.names} for r in (a, b))
    columns = {
        "total": pc.add(x["total"], y["total"]),
        "head": pc.max_element_wise(x["head"], pc.add(x["total"], y["head"])),
        "tail": pc.max_element_wise(y["tail"], pc.add(y["total"], x["tail"])),
        "best": pc.max_element_wise(x["best"], y["best"], pc.add(x["tail"], y["head"])),
    }
    return pa.RecordBatch.from_arrays([columns[n] for n in a.schema.names], names=a.schema.names)


@query("""
    WITH e AS (SELECT *, round(value * 100)::BIGINT - 5000 AS gain FROM events),
    r AS (SELECT *, (sum(gain) OVER w)::BIGINT AS s FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    b AS (SELECT *, least(0, coalesce(min(s) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM r)
    SELECT event_type, arg_max(s, (ts, event_id)) AS total, max(s - low) AS best FROM b GROUP BY event_type""")
def user_fold_best_run(spark, folder):
    """A user's own fold: the run of consecutive events of a type with the largest sum of (value - 50), in hundredths.
    Five keys hold all rows and are cut into slices."""
    events = read_table(spark, folder, "events")
    gain = (F.round(F.col("value") * 100).cast("long") - 5000).alias("gain")
    rows = events.select("event_type", "ts", "event_id", gain)
    rows = rows.select("event_type", "ts", "event_id", *[F.col("gain").alias(n) for n in ("total", "head", "tail", "best")])
    folded = reduce_by_key(rows, ["event_type"], ["total", "head", "tail", "best"], _best_run, IN_ORDER, _share(rows))
    return folded.select("event_type", "total", "best")


@query("SELECT user_id, 1::BIGINT AS n_partitions, count(*) AS n FROM events GROUP BY user_id")
def key_affinity(spark, folder):
    placed = partition_by_key(read_table(spark, folder, "events").select("user_id"), "user_id")
    per_place = placed.withColumn("place", F.spark_partition_id()).groupBy("user_id", "place").count()
    return per_place.groupBy("user_id").agg(F.count("*").alias("n_partitions"), F.sum("count").alias("n"))


# --- sequences and event-time windows ---


@query("""
    WITH t AS (SELECT (max(event_id) + 1) // 2 AS half FROM events)
    SELECT event_id + 1 AS n, CASE WHEN event_id + 1 <= half THEN (event_id + 1) * 1000
        ELSE (event_id + 1 - half) * 1000 END AS v
    FROM events, t""")
def sequence_map(spark, folder):
    """The events by their numbers, as a sequence that goes back half-way."""
    numbers = read_table(spark, folder, "events").select((F.col("event_id") + 1).alias("n"))
    half = numbers.agg(F.max("n")).first()[0] // 2
    return numbers.select("n", fold_sequence(F.col("n"), half).alias("v"))


@query("""
    WITH t AS (SELECT (max(event_id) + 1) // 2 AS half FROM events),
         s AS (SELECT event_id + 1 AS n,
                  CASE WHEN event_id + 1 <= half THEN (event_id + 1) * 1000
                       ELSE (event_id + 1 - half) * 1000 END AS v
               FROM events, t)
    SELECT 'Window closed at event-time ' || arg_max(v, (v, n)) AS message FROM s GROUP BY v // 3000""")
def sequence_window_last(spark, folder):
    events = read_table(spark, folder, "events").select((F.col("event_id") + 1).alias("n"))
    half = events.agg(F.max("n")).first()[0] // 2
    return jobs.sequence_windows(events, half).select("message")


_HOURLY_LAST = """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
        time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
        arg_max(value, (ts, event_id)) AS last, count(*) AS n
    FROM events GROUP BY ALL"""


@query(_HOURLY_LAST)
def tumbling_window_last(spark, folder):
    return tumbling_last(read_table(spark, folder, "events"), "1 hour", "value", IN_ORDER)


@query("""
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type,
        round(sum(value), 4) AS total, count(*) AS n, round(avg(value), 6) AS mean
    FROM events GROUP BY ALL""")
def tumbling_window_totals(spark, folder):
    aggs = [
        F.round(F.sum("value"), 4).alias("total"),
        F.count("*").alias("n"),
        F.round(F.avg("value"), 6).alias("mean"),
    ]
    return tumbling(read_table(spark, folder, "events"), "1 hour", aggs, ["event_type"]).drop("window_end")


@query("""
    SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, user_id::VARCHAR AS "patientId",
        round(avg(value), 6) AS lat, round(avg((props->>'$.k')::DOUBLE), 6) AS lon
    FROM events GROUP BY ALL""")
def average_location_per_key(spark, folder):
    events = read_table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("double").alias("lon")
    places = events.select(F.col("user_id").cast("string").alias("patientId"), F.col("value").alias("lat"), k, "ts")
    means = jobs.average_location(places)
    return means.select(
        "window_start", "patientId", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")
    )


@query("""
    SELECT time_bucket(INTERVAL '30 minutes', ts) - i * INTERVAL '30 minutes' AS window_start, count(*) AS n
    FROM events, (VALUES (0), (1)) AS s(i) GROUP BY ALL""")
def sliding_window_count(spark, folder):
    events = read_table(spark, folder, "events")
    return tumbling(events, "1 hour", [F.count("*").alias("n")], slide="30 minutes").drop("window_end")


# --- windows that end with the data ---

_UNTIL = """
    WITH g AS (SELECT *, coalesce(sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id
            ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS window_no
        FROM events)"""
_UNTIL_LISTS = _UNTIL + """
    SELECT user_id, window_no, count(*) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS ids
    FROM g GROUP BY user_id, window_no HAVING bool_or(event_type = 'purchase')"""
_UNTIL_CAPPED = _UNTIL + """,
    c AS (SELECT *, (row_number() OVER (PARTITION BY user_id, window_no ORDER BY ts, event_id) - 1) // 3 AS chunk
        FROM g)
    SELECT user_id, window_no, chunk, count(*) AS n,
        string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS ids
    FROM c GROUP BY user_id, window_no, chunk HAVING bool_or(event_type = 'purchase') OR count(*) = 3"""
# Windows of one day at most, by the millisecond: from each start to the next row that is a day
# later or follows a purchase.
_UNTIL_TIMEOUT = """
    WITH RECURSIVE e AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
            coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = 'purchase', false) AS fresh
        FROM events),
    s AS (
        SELECT user_id, pos, ts, 0::BIGINT AS window_no FROM e WHERE pos = 1
        UNION ALL
        SELECT s.user_id, min(e.pos), min(e.ts), min(s.window_no) + 1
        FROM s JOIN e ON e.user_id = s.user_id AND e.pos > s.pos
            AND (e.fresh OR epoch_ms(e.ts) >= epoch_ms(s.ts) + 86400000)
        GROUP BY s.user_id)
    SELECT e.user_id, e.event_id, max(s.window_no) AS window_no
    FROM e JOIN s ON e.user_id = s.user_id AND s.pos <= e.pos GROUP BY e.user_id, e.event_id"""


def _events_to_gather(spark, folder):
    return read_table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")


def _lists(rows: DataFrame, by: tuple[str, ...] = ("window_no",)) -> DataFrame:
    return gather_windows(rows, ["user_id"], IN_ORDER, ["event_id"], by).select("user_id", *by, "n", _ids())


@query(_UNTIL_LISTS)
def conditional_window(spark, folder):
    return _lists(windows_until(_events_to_gather(spark, folder), ["user_id"], IN_ORDER, F.expr(PURCHASE)))


@query("""
    WITH g AS (SELECT *, coalesce(sum((value > 100)::INT) OVER (PARTITION BY event_type
            ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS window_no
        FROM events)
    SELECT event_type, window_no, count(*) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS ids
    FROM g GROUP BY event_type, window_no HAVING bool_or(value > 100)""")
def conditional_window_hot_keys(spark, folder):
    """Five keys hold all rows and every one is cut into slices; up to a value above 100."""
    events = read_table(spark, folder, "events").select("event_type", "event_id", "value", "ts")
    rows = windows_until(events, ["event_type"], IN_ORDER, F.col("value") > 100, _share(events))
    return gather_windows(rows, ["event_type"], IN_ORDER, ["event_id"]).select("event_type", "window_no", "n", _ids())


@query(_UNTIL + """
    SELECT user_id, event_id, window_no FROM g
    WHERE window_no < (SELECT count(*) FROM events p WHERE p.user_id = g.user_id AND p.event_type = 'purchase')""")
def conditional_window_rows(spark, folder):
    """Labelled rows instead of lists: for windows of any length."""
    rows = windows_until(_events_to_gather(spark, folder), ["user_id"], IN_ORDER, F.expr(PURCHASE))
    return rows.select("user_id", "event_id", "window_no")


@query(_UNTIL_CAPPED)
def conditional_window_capped(spark, folder):
    events = _events_to_gather(spark, folder)
    return _lists(windows_until_capped(events, ["user_id"], IN_ORDER, F.expr(PURCHASE), 3), ("window_no", "chunk"))


@query(_UNTIL_TIMEOUT)
def conditional_window_timeout(spark, folder):
    # the table's times carry no zone; windows only look at differences
    events = _events_to_gather(spark, folder).withColumn("ts", _zoned("ts"))
    rows = windows_until_timeout(events, ["user_id"], "ts", ["event_id"], F.expr(PURCHASE), 86_400)
    return rows.select("user_id", "event_id", "window_no")


# --- interval joins ---

_SIGNUP_ERRORS = """
    SELECT s.user_id, s.event_id AS signup_id, e.event_id AS error_id
    FROM events s JOIN events e ON s.user_id = e.user_id
        AND e.ts BETWEEN s.ts AND s.ts + INTERVAL '6 hours'
    WHERE s.event_type = 'signup' AND e.event_type = 'error'"""


def _sides(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    signups = events.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("signed_up"))
    errors = events.where("event_type = 'error'").select("user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("failed"))
    return signups, errors


@query(_SIGNUP_ERRORS)
def interval_join_signup_errors(spark, folder):
    """Errors that a user meets within six hours of a signup."""
    pairs = interval_join(*_sides(read_table(spark, folder, "events")), ["user_id"], "signed_up", "failed", "0 hours", "6 hours")
    return pairs.select("user_id", "signup_id", "error_id")


@query("""
    SELECT a.event_id AS purchase_id, b.event_id AS error_id
    FROM events a JOIN events b ON b.ts BETWEEN a.ts - INTERVAL '20 minutes' AND a.ts - INTERVAL '1 minute'
    WHERE a.event_type = 'purchase' AND b.event_type = 'error'""")
def interval_join_one_key(spark, folder):
    """All rows under one key: purchases and the errors of anyone in the minutes before."""
    events = read_table(spark, folder, "events").withColumn("all", F.lit(0))
    bought = events.where(PURCHASE).select("all", F.col("event_id").alias("purchase_id"), F.col("ts").alias("bought"))
    failed = events.where("event_type = 'error'").select("all", F.col("event_id").alias("error_id"), F.col("ts").alias("failed"))
    pairs = interval_join(bought, failed, ["all"], "bought", "failed", "-20 minutes", "-1 minute")
    return pairs.select("purchase_id", "error_id")


# --- JSON records ---

PROPS = T.StructType([T.StructField("k", T.IntegerType())])


@query("SELECT event_id, (props->>'$.k')::INT AS k FROM events")
def json_fields(spark, folder):
    records, _ = parse_json(read_table(spark, folder, "events").select("event_id", "props"), PROPS, "props")
    return flatten_valid(records, "event_id")


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN (props->>'$.k')::INT END AS k,
        CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) END AS unread
    FROM events""")
def json_quarantine(spark, folder):
    """Error events lose their last brace; they must all turn up in the quarantine."""
    cut = F.expr("if(event_type = 'error', substr(props, 1, length(props) - 1), props)").alias("text")
    events = read_table(spark, folder, "events").select("event_id", cut)
    flagged = parse_flagged(events, PROPS, "text")
    return flagged.select("event_id", "record.k", F.when(F.col("unread"), F.col("text")).alias("unread"))


# Every fifth message is cut short, every seventh of the others has a latitude that is no number.
@query("""
    WITH m AS (SELECT event_id, user_id, value, (props->>'$.k')::DOUBLE AS k, event_id % 5 = 0 AS broken,
        event_id % 5 <> 0 AND event_id % 7 = 0 AS odd FROM events)
    SELECT event_id, CASE WHEN NOT broken AND NOT odd THEN 'Patient ' || user_id || ' at location (' || value || ', ' || k || ')' END AS line,
        broken OR odd AS unread
    FROM m""")
def location_lines(spark, folder):
    """Location messages as sentences; lines and quarantine together are all messages."""
    k = F.get_json_object("props", "$.k").cast("double").alias("lon")
    lat = F.when((F.col("event_id") % 5 != 0) & (F.col("event_id") % 7 == 0), "north").otherwise(F.col("value").cast("string"))
    text = F.to_json(F.struct(F.col("user_id").cast("string").alias("patientId"), lat.alias("lat"), k))
    cut = F.when(F.col("event_id") % 5 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    messages = read_table(spark, folder, "events").select("event_id", cut.alias("value"))
    return jobs.location_lines_flagged(messages).select("event_id", "line", "unread")


@query("""
    SELECT event_id, 'Patient ' || user_id || ' at location (' || value || ', '
        || (props->>'$.k')::DOUBLE || ')' AS line
    FROM events""")
def json_sentence(spark, folder):
    k = F.get_json_object("props", "$.k").cast("double").alias("lon")
    fields = F.struct(F.col("user_id").cast("string").alias("patientId"), F.col("value").alias("lat"), k)
    messages = read_table(spark, folder, "events").select("event_id", F.to_json(fields).alias("value"))
    locations, _ = parse_locations(messages)
    sentence = location_sentence(F.col("patientId"), F.col("lat"), F.col("lon"))
    return locations.select("event_id", sentence.alias("line"))


@query(_UNTIL + """
    SELECT user_id, window_no, '[' || string_agg('{"event_id":' || event_id || ',"event_type":"' || event_type
        || '"}', ',' ORDER BY ts, event_id) || ']' AS value
    FROM g GROUP BY user_id, window_no HAVING bool_or(event_type = 'purchase')""")
def json_rows(spark, folder):
    rows = windows_until(_events_to_gather(spark, folder), ["user_id"], IN_ORDER, F.expr(PURCHASE))
    windows = gather_windows(rows, ["user_id"], IN_ORDER, ["event_id", "event_type"])
    return windows.select("user_id", "window_no", records_to_json(F.col("events")).alias("value"))


# --- files and lines ---


def _event_lines(spark, folder) -> DataFrame:
    line = F.concat_ws(":", F.col("user_id").cast("string"), "props").alias("value")
    return read_table(spark, folder, "events").select(line)


@query("SELECT user_id::VARCHAR AS key, props AS value FROM events")
def keyed_line_split(spark, folder):
    return sources.keyed_lines(_event_lines(spark, folder))


@query("""
    SELECT event_id, 0::INT AS position, user_id::VARCHAR AS field FROM events
    UNION ALL SELECT event_id, 1, event_type || ':"' || value || '"' FROM events
    UNION ALL SELECT event_id, 2, props FROM events
    UNION ALL SELECT event_id, 3, '' FROM events""")
def quoted_line_fields(spark, folder):
    """Keyed lines whose second and third field hold separators and quotes within quotes."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    second = quote(F.concat("event_type", F.lit(':"'), F.col("value").cast("string"), F.lit('"')))
    line = F.concat_ws(":", F.col("user_id").cast("string"), second, quote(F.col("props")), F.lit(""))
    lines = read_table(spark, folder, "events").select("event_id", line.alias("line"))
    return quoted_fields(lines, "line", "event_id")


@query("SELECT user_id::VARCHAR AS key, props AS value FROM events")
def text_file_lines(spark, folder):
    """Lines written to text files and read back."""
    path = new_folder(spark, "lines")
    _event_lines(spark, folder).write.text(path)
    return sources.keyed_lines(sources.read_lines(spark, path))


CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
    ]
)


def _customer_csv(spark, folder) -> str:
    path = new_folder(spark, "csv")
    read_table(spark, folder, "customer").select(*CUSTOMER.names).write.csv(path)
    return path


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_file_rows(spark, folder):
    return sources.read_csv(spark, _customer_csv(spark, folder), CUSTOMER, mode="FAILFAST")


@query("""
    SELECT c_custkey || ' ' || c_name || ' ' || c_mktsegment AS value FROM customer""")
def delimited_text_sink(spark, folder):
    path = new_folder(spark, "delimited")
    sinks.write_delimited(read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return sources.read_lines(spark, path)


# --- streams (each runs to the end of its table; the result is read from a table it wrote) ---


def _zoned(name: str) -> Column:
    """A zoneless time as a timestamp: streams take no other."""
    return F.col(name).cast("timestamp")


def _unzoned(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _event_stream(spark, folder, *columns: str, limits=LIMITS) -> DataFrame:
    events = stream_table(spark, folder, "events", **limits).select(*columns)
    return events.withColumn("ts", _zoned("ts")) if "ts" in columns else events


@query("SELECT p_partkey, upper(p_name) AS p_name FROM part")
def stream_upper_map(spark, folder):
    def build():
        return upper_lines(stream_table(spark, folder, "part", **LIMITS).select("p_partkey", "p_name"), "p_name")

    return append_to_table(build, spark)


@query(_WORD_COUNT)
def stream_word_count(spark, folder):
    def build():
        return jobs.word_count(stream_table(spark, folder, "documents", **LIMITS), "text")

    return latest_to_table(build, spark, ["word"])


@query(_RUNNING_WORDS)
def stream_running_word_count(spark, folder):
    """Each record answered: a row for each word of each text, in order of the documents."""

    def build():
        return stream_table(spark, folder, "documents", **LIMITS).select("doc_id", "text")

    return jobs.running_word_count_to_table(build, spark, ["doc_id"], "text")


@query(_RUNNING)
def stream_running_count(spark, folder):
    def build():
        events = _event_stream(spark, folder, "event_id", "event_type", "ts", limits=STATEFUL_LIMITS)
        return running_count_stream(events, ["event_type"], IN_ORDER).drop("ts")

    return append_to_table(build, spark)


@query(_RUNNING)
def stream_running_count_hot_keys(spark, folder):
    """Micro-batches of any size and keys of any size: five keys hold all rows, each is cut."""

    def build():
        return _event_stream(spark, folder, "event_id", "event_type", "ts")

    split_rows = _share(read_table(spark, folder, "events"))
    counted = running_total_by_batch(build, spark, ["event_type"], IN_ORDER, "cnt", split_rows=split_rows)
    return counted.drop("ts")


@query(_LATEST_PER_KEY)
def stream_latest_per_key(spark, folder):
    """A state for each key, which goes when the key has been quiet for a day."""

    def build():
        events = _event_stream(spark, folder, "user_id", "event_id", "event_type", "value", "ts", limits=STATEFUL_LIMITS)
        timed = with_event_time(events, F.col("ts"), "1 minute")
        return latest_by_key_stream(timed, ["user_id"], IN_ORDER, ["event_type", "value", "ts"], quiet_seconds=86_400)

    return _unzoned(latest_to_table(build, spark, ["user_id"]), "ts")


@query(_HOURLY_LAST)
def stream_tumbling_window_append(spark, folder):
    def source():
        return _event_stream(spark, folder, "event_id", "value", "ts")

    def build(events):
        timed = with_event_time(events, F.col("ts"), "10 seconds")
        return _unzoned(tumbling_last(timed, "1 hour", "value", IN_ORDER), "window_start", "window_end")

    return append_and_close(source, build, spark, "ts")


@query(_HOURLY_LAST)
def stream_tumbling_window_update(spark, folder):
    def build():
        events = _event_stream(spark, folder, "event_id", "value", "ts")
        timed = with_event_time(events, F.col("ts"), "10 seconds")
        return _unzoned(tumbling_last(timed, "1 hour", "value", IN_ORDER), "window_start", "window_end")

    return latest_to_table(build, spark, ["window_start"])


def _stream_until(spark, folder, **ends) -> DataFrame:
    def source():
        return _event_stream(spark, folder, "user_id", "event_id", "event_type", "ts", limits=STATEFUL_LIMITS)

    def build(events):
        return windows_until_stream(events, ["user_id"], IN_ORDER, F.expr(PURCHASE), ["event_id"], **ends)

    if "seconds" not in ends:
        return append_to_table(lambda: build(source()), spark)
    return append_and_close(
        source, lambda events: build(with_event_time(events, F.col("ts"), "0 seconds")), spark, "ts"
    )


def _windows_by_batch(spark, folder, **ends) -> DataFrame:
    def build():
        return _event_stream(spark, folder, "user_id", "event_id", "event_type", "ts")

    return windows_by_batch(build, spark, ["user_id"], IN_ORDER, PURCHASE, **ends)


def _stream_lists(rows: DataFrame) -> DataFrame:
    return gather_windows(rows, ["user_id"], ["place"], ["event_id"]).select("user_id", "window_no", "n", _ids())


@query(_UNTIL_LISTS)
def stream_conditional_window(spark, folder):
    return _stream_lists(_stream_until(spark, folder))


@query(_UNTIL_LISTS)
def stream_conditional_window_by_batch(spark, folder):
    def build():
        return _event_stream(spark, folder, "user_id", "event_id", "event_type", "ts")

    return _lists(windows_until_by_batch(build, spark, ["user_id"], IN_ORDER, PURCHASE))


@query(_SIGNUP_ERRORS)
def stream_interval_join(spark, folder):
    """The same of two streams: what can meet no more leaves the state as the watermarks pass."""

    def build():
        sides = [_event_stream(spark, folder, "user_id", "event_id", "event_type", "ts") for _ in range(2)]
        signups, errors = _sides(sides[0])[0], _sides(sides[1])[1]
        timed = signups.withWatermark("signed_up", "1 minute"), errors.withWatermark("failed", "1 minute")
        return interval_join(*timed, ["user_id"], "signed_up", "failed", "0 hours", "6 hours")

    return append_to_table(build, spark).select("user_id", "signup_id", "error_id")


# Three arrivals: each third of the events comes with its time, but for every tenth event, which comes last.
_ARRIVALS = """
    WITH t AS (SELECT max(event_id) + 1 AS n FROM events),
    a AS (SELECT event_id, ts, CASE WHEN event_id % 10 = 3 THEN 2 ELSE event_id * 3 // n END AS arrival FROM events, t),
    m AS (SELECT k, (SELECT max(ts) FROM a WHERE arrival < k) - INTERVAL '1 day' AS watermark FROM range(0, 3) AS r(k))
    SELECT event_id, arrival::INT AS arrival, coalesce(ts < watermark, false) AS late
    FROM a JOIN m ON k = arrival"""


@query(_ARRIVALS)
def stream_late_rows(spark, folder):
    """Rows in time and late rows of three micro-batches, with a day's delay: together all rows."""
    events = read_table(spark, folder, "events").select("event_id", _zoned("ts").alias("ts"))
    n = events.agg(F.max("event_id")).first()[0] + 1
    arrival = F.when(F.col("event_id") % 10 == 3, 2).otherwise(F.expr(f"event_id * 3 div {n}")).cast("int")
    path = new_folder(spark, "arrivals")
    for k in range(3):  # a stream takes files by the time they were written
        events.withColumn("arrival", arrival).where(F.col("arrival") == k).coalesce(1).write.mode("append").parquet(path)

    def build():
        return spark.readStream.schema("event_id long, ts timestamp, arrival int").option("maxFilesPerTrigger", 1).parquet(path)

    in_time, late = split_late_by_batch(build, spark, "ts", 86_400)
    both = [df.select("event_id", "arrival", F.lit(flag).alias("late")) for df, flag in ((in_time, False), (late, True))]
    return both[0].unionByName(both[1])


# The stream numbers a key's windows through, whatever closed them.
@query("""
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY window_no, chunk) - 1 AS window_no, n, ids
    FROM (""" + _UNTIL_CAPPED + ")")
def stream_conditional_window_capped(spark, folder):
    return _lists(_windows_by_batch(spark, folder, max_events=3))


@query(_UNTIL_TIMEOUT)
def stream_conditional_window_timeout(spark, folder):
    return _windows_by_batch(spark, folder, seconds=86_400, close=True).select("user_id", "event_id", "window_no")


# The same with a state for each key instead of tables, for small, frequent micro-batches.
@query("""
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY window_no, chunk) - 1 AS window_no, n, ids
    FROM (""" + _UNTIL_CAPPED + ")")
def stream_conditional_window_capped_by_state(spark, folder):
    return _stream_lists(_stream_until(spark, folder, max_events=3))


@query(_UNTIL_TIMEOUT)
def stream_conditional_window_timeout_by_state(spark, folder):
    return _stream_until(spark, folder, seconds=86_400).select("user_id", "event_id", "window_no")


@query("SELECT user_id::VARCHAR AS key, props AS value FROM events")
def stream_text_lines(spark, folder):
    path = new_folder(spark, "lines")
    _event_lines(spark, folder).write.text(path)
    return append_to_table(lambda: sources.keyed_lines(sources.watch_lines(spark, path, **LIMITS)), spark)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def stream_csv_rows(spark, folder):
    path = _customer_csv(spark, folder)
    return append_to_table(lambda: sources.watch_csv(spark, path, CUSTOMER, mode="FAILFAST", **LIMITS), spark)


# --- topics, on frames of the topic row schema made from the events ---


def _topic_rows(events: DataFrame) -> DataFrame:
    """Events as topic rows: key the user, value the event as JSON, one partition, in order."""
    fields = F.struct(
        F.col("user_id").cast("string").alias("patientId"),
        F.col("event_id").cast("string").alias("position"),
        F.col("event_type").alias("status"),
    )
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(fields).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


@query("""
    SELECT upper('{"patientId":"' || user_id || '","position":"' || event_id || '","status":"' || event_type
        || '"}') AS value
    FROM events""")
def topic_to_topic_map(spark, folder):
    return jobs.topic_to_topic(_topic_rows(read_table(spark, folder, "events")))


@query(_UNTIL + """
    SELECT user_id::VARCHAR AS key, '[' || string_agg('{"patientId":"' || user_id || '","position":"' || event_id
        || '","status":"' || event_type || '"}', ',' ORDER BY ts, event_id) || ']' AS value
    FROM g GROUP BY user_id, window_no HAVING bool_or(event_type = 'purchase')""")
def stream_topic_windows(spark, folder):
    """The whole topic-to-topic chain: parse, gather per patient until the condition, JSON lists."""

    def build():
        return _topic_rows(stream_table(spark, folder, "events", **LIMITS))

    rows, _ = jobs.patient_windows_to_table(build, spark, "purchase")
    return jobs.patient_window_messages(rows, ["partition", "offset"])


# Every ninth message is cut short.
@query("""
    SELECT event_id AS "offset", '{"patientId":"' || user_id || '","position":"' || event_id || '","status":"' || event_type || '"' AS value
    FROM events WHERE event_id % 9 = 4""")
def stream_topic_unread(spark, folder):
    """The messages of the same chain that could not be read, as they came."""

    def build():
        messages = _topic_rows(stream_table(spark, folder, "events", **LIMITS))
        whole = F.col("value").cast("string")
        cut = F.when(F.col("offset") % 9 == 4, F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
        return messages.withColumn("value", cut.cast("binary"))

    return jobs.patient_windows_to_table(build, spark, "purchase")[1].select("offset", "value")
