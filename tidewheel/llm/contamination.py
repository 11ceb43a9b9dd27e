"""Benchmark decontamination in DataFrame functions only.

A window of L words lies in a text only if a block of it does: of the blocks of ceil(L/2) words at every
(L - ceil(L/2) + 1)-th word of the text, exactly one starts in the window's first words and lies within it. So a
text gives one block for six words (L = 10), looked up by hash in the blocks of all windows; a hit is verified
word by word in place. The windows are broadcast if their number is within ``BROADCAST_WINDOWS``; else blocks go to them
by hash without the text, and what is found goes back to its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: At most so many windows are broadcast: each stands in six rows of about 300 bytes.
BROADCAST_WINDOWS = 100_000
#: Parts that texts with the same block are dealt to where windows are joined by shuffle.
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lowered.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-case words: ASCII letters, digits and all beyond ASCII; none for null."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window: array of words, item_ids): the distinct windows of all items; an item of fewer words is one window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = F.transform(starts, lambda i: F.slice("w", i, window))
    return items.select("item_id", F.explode(cut).alias("window")).groupBy("window").agg(F.collect_set("item_id").alias("item_ids"))


def _block(length: Column | int) -> Column:
    return F.ceil(F.lit(length) / 2).cast("int") if isinstance(length, int) else F.ceil(length / 2).cast("int")


def _blocks(windows: DataFrame) -> DataFrame:
    """(block, offset, length, window, item_ids): each block that may stand for a window in a text."""
    length = F.size("window")
    offsets = F.sequence(F.lit(0), length - _block(length))
    key = F.xxhash64(F.col("length"), F.slice("window", F.col("offset") + 1, _block(F.col("length"))))
    exploded = windows.select("window", "item_ids", length.alias("length"), F.explode(offsets).alias("offset"))
    return exploded.select(key.alias("block"), "offset", F.col("length").alias("found_length"), "window", "item_ids")


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each distinct (doc_id, text): doc_id, text_hash, copies, n_words, spans, item_ids.

    ``spans`` are (start, length) of each occurrence of a window, counted in words from 1; ``item_ids`` the items whose
    windows occur, ``copies`` the rows of ``documents`` with that doc_id and text. Null or wordless texts have 0 words
    and no spans. An empty benchmark finds nothing.
    """
    windows = benchmark_windows(benchmark, window)
    found = windows.groupBy(F.size("window").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    lengths = sorted(r.length for r in found)  # 1 to ``window``: a fixed few
    table = _blocks(windows)

    def blocks_of(length: int) -> Column:
        block = -(-length // 2)
        step = length - block + 1
        starts = F.sequence(F.lit(1), F.greatest(F.col("n_words") - block + 1, F.lit(1)), F.lit(step))
        cut = F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(length), F.slice("w", i, block)).alias("block")))
        return F.when(F.col("n_words") >= length, cut).otherwise(F.array().cast("array<struct<at:int,block:bigint>>"))

    own_row = F.array(F.struct(F.lit(0).alias("at"), F.lit(None).cast("long").alias("block")))
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    texts = texts.select("doc_id", "text_hash", "w", F.size("w").alias("n_words"))
    if sum(r.n for r in found) > BROADCAST_WINDOWS:
        return _hits_by_shuffle(texts, table, F.concat(*[blocks_of(n) for n in lengths]))
    table = F.broadcast(table)
    texts = texts.select("*", F.explode(F.concat(own_row, *[blocks_of(n) for n in lengths])).alias("b"))
    texts = texts.select("doc_id", "text_hash", "w", "n_words", "b.at", "b.block")
    start = F.col("at") - F.col("offset")
    same = (start >= 1) & (F.slice("w", F.greatest(start, F.lit(1)), F.col("found_length")) == F.col("window"))
    joined = texts.join(table, "block", "left").where((F.col("at") == 0) | same)
    span = F.when(F.col("at") > 0, F.struct(start.alias("start"), F.col("found_length").alias("length")))
    return (
        joined.select("doc_id", "text_hash", "n_words", span.alias("span"), "item_ids", (F.col("at") == 0).cast("long").alias("own"))
        .groupBy("doc_id", "text_hash")
        .agg(
            F.sum("own").alias("copies"),
            F.max("n_words").cast("long").alias("n_words"),
            F.collect_set("span").alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("item_ids"),
        )
    )


def _hits_by_shuffle(texts: DataFrame, table: DataFrame, blocks: Column) -> DataFrame:
    """:func:`hits` for windows that are too many to broadcast: a row of 40 bytes goes for each block, a text goes once."""
    known = texts.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"), F.max("n_words").cast("long").alias("n_words"), F.first("w").alias("w"))
    # texts with the same block are dealt over salts, to each of which its windows go
    salt = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int")
    asked = known.select("doc_id", "text_hash", "n_words", "w").select("doc_id", "text_hash", salt.alias("salt"), F.explode(blocks).alias("b"))
    asked = asked.select("doc_id", "text_hash", "salt", "b.at", "b.block")
    table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    start = (F.col("at") - F.col("offset")).alias("start")
    found = asked.join(table, ["block", "salt"]).select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), start, "found_length", "window", "item_ids").where("start >= 1")
    own = F.col("of").eqNullSafe(F.col("doc_id")) & F.col("of_hash").eqNullSafe(F.col("text_hash"))
    same = F.slice("w", F.col("start"), F.col("found_length")) == F.col("window")
    true = found.join(known.select("doc_id", "text_hash", "w"), own).where(same)
    span = F.struct("start", F.col("found_length").alias("length"))
    hit = true.groupBy("of", "of_hash").agg(F.collect_set(span).alias("spans"), F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("item_ids"))
    kinds = dict(hit.dtypes)
    some = [F.coalesce(c, F.array().cast(kinds[c])).alias(c) for c in ("spans", "item_ids")]
    return known.drop("w").join(hit, own, "left").select("doc_id", "text_hash", "copies", "n_words", *some)


def _hit_words(spans: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items (long), items (sorted strings), contaminated (boolean) for each row of ``documents``.

    ``n_hit`` counts the words inside any occurrence of a window. Rows that repeat a doc_id and text get equal rows;
    rows that repeat a doc_id with other texts are judged each by its own. Null item_ids stand for no item.
    """
    n_hit = F.size(_hit_words(F.col("spans"))).cast("long")
    items = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    found = hits(documents, benchmark, window).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), items.alias("items"), (n_hit > 0).alias("contaminated"), "copies"
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")


def without_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents``, as they are, that hold no window of the benchmark."""
    bad = hits(documents, benchmark, window).where(F.size("spans") > 0).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(documents["text"]) == bad["bad_hash"]), "left_anti")


def without_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with the words of all occurrences taken out of ``text``, what stands between words left as it is."""
    bad = hits(documents, benchmark, window).where(F.size("spans") > 0)
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"), _hit_words(F.col("spans")).alias("hit_words"))
    text, names = documents["text"], documents.columns
    joined = documents.join(bad, documents["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(text) == bad["bad_hash"]), "left")
    between = F.split(text, CASED_WORD)
    found = F.regexp_extract_all(text, F.lit(CASED_WORD), F.lit(0))
    marked = F.transform(found, lambda w, i: F.when(F.array_contains(bad["hit_words"], i + 1), F.lit("")).otherwise(w))
    rebuilt = F.array_join(F.flatten(F.transform(F.arrays_zip(between.alias("b"), marked.alias("m")), lambda z: F.array(z["b"], F.coalesce(z["m"], F.lit(""))))), "")
    cut = F.when(bad["bad_hash"].isNull(), text).otherwise(rebuilt)
    return joined.select(*[cut.alias("text") if n == "text" else documents[n] for n in names])
