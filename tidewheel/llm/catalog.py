"""The queries of these operators over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewheel.llm import audit, contamination, jaccard, language, packing, pages, quality, sharding, substrings, tokencounts, urls, veccodes, vectors
from tidewheel.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extracted(read(spark, folder, "pages"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read(spark, folder, "documents"), ids=False, tokens=packing.model_tokenizer)


@query
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, folder, "documents"))


@query
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scored = language.scored(read(spark, folder, "documents"), language.trained_on(F.col("doc_id")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, folder, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


@query
def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(read(spark, folder, "embeddings"))


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    placed = sharding.written(sharding.sharded(read(spark, folder, "documents").withColumn("size", size), "size"))
    return placed.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The listed rules of the query: verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(read(spark, folder, "pages"), read(spark, folder, "labels"), URL_RULES)


@query
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    model = quality.fit(documents, read(spark, folder, "labels"))
    scored = quality.scored(documents, model)
    return scored.select("doc_id", (~quality.trained_on(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audited(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return veccodes.codes(read(spark, folder, "embeddings"))


@query
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.counted(read(spark, folder, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run

ORACLES["op2_decontamination"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), grams AS (
  SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: list_slice(w, i, i + 9))) AS g FROM items WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT len(g) AS l FROM grams
), places AS (
  SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM docs, sizes WHERE len(w) >= l
), hits AS (
  SELECT DISTINCT p.doc_id, p.i, p.l, g.item_id FROM places p JOIN grams g ON list_slice(p.w, p.i, p.i + p.l - 1) = g.g
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS j FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
"""

ORACLES["op6_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 19) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later
), words AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM docs
), kept AS (
  SELECT d.doc_id, string_agg(d.x, ' ' ORDER BY d.j) AS t FROM words d ANTI JOIN gone g ON d.doc_id = g.doc_id AND d.j = g.j GROUP BY d.doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""

ORACLES["op11_filter_audit"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), judged AS (
  SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM texts
), rows AS (
  SELECT part, fails, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM judged
), sets AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM rows GROUP BY part, fails
), orders AS (
  SELECT '' AS filter_order, 0 AS l
  UNION ALL
  SELECT filter_order || f, l + 1 FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(f) WHERE NOT contains(filter_order, f)
), steps AS (
  SELECT filter_order, CAST(step AS INT) AS step, instr('ABCDE', substr(filter_order, CAST(step AS INT), 1)) AS own,
    list_transform(range(1, step), lambda i: instr('ABCDE', substr(filter_order, CAST(i AS INT), 1))) AS earlier
  FROM orders, range(1, 6) AS r(step) WHERE l = 5
), counted AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS fails_own, list_bool_or(list_transform(earlier, lambda i: fails[i])) AS gone,
    list_sum(list_transform(fails, lambda f: f::INT)) AS failed
  FROM sets, (SELECT * FROM steps) s
), found AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT coalesce(gone, false) AND NOT fails_own), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT coalesce(gone, false) AND fails_own), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (coalesce(gone, false) AND fails_own), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails_own AND failed = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT coalesce(gone, false) AND fails_own), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT coalesce(gone, false) AND fails_own), 0)::BIGINT AS toxic_lost
  FROM counted GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM found
"""

_NEAREST = """
  SELECT r.vec_id, r.label, r.p, arg_min(b.e, (list_sum(list_transform(list_zip(r.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e)) AS e,
    min(list_sum(list_transform(list_zip(r.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d, any_value(r.x) AS x
  FROM cut r JOIN {book} b USING (p) GROUP BY r.vec_id, r.label, r.p"""
_MEANS = """
  SELECT b.p, b.e, CASE WHEN count(a.e) = 0 THEN any_value(b.x) ELSE list_transform(range(1, 1 + any_value(len(b.x))), lambda i:
    floor(list_sum(list_transform(list(a.x), lambda v: v[i])) / count(a.e))::BIGINT) END AS x
  FROM {book} b LEFT JOIN {near} a USING (p, e) GROUP BY b.p, b.e"""
ORACLES["op12_vector_codes"] = f"""
WITH ints AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS (
  SELECT vec_id, label, p, list_slice(x, p * len(x) // 16 + 1, (p + 1) * len(x) // 16) AS x FROM ints, range(0, 16) AS r(p)
), seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM ints QUALIFY e < 64
), book0 AS (
  SELECT p, e, x FROM cut JOIN seeds USING (vec_id)
), near0 AS MATERIALIZED ({_NEAREST.format(book="book0")}
), book1 AS MATERIALIZED ({_MEANS.format(book="book0", near="near0")}
), near1 AS MATERIALIZED ({_NEAREST.format(book="book1")}
), book2 AS MATERIALIZED ({_MEANS.format(book="book1", near="near1")}
), near2 AS MATERIALIZED ({_NEAREST.format(book="book2")}
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""

ORACLES["op4_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
  FROM docs WHERE len(w) > 0
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) = any_value(a.n) AND count(*) = any_value(b.n) AS same
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 10 * count(*) >= 8 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT doc_id, least(doc_id, (SELECT min(y) FROM links WHERE x = doc_id AND same)) AS copy_id,
  (SELECT count(*) FROM links WHERE x = doc_id) AS n_links, (SELECT min(y) FROM reached WHERE x = doc_id) AS class_id
FROM docs
"""
