"""The pipeline's stages on the smallest tables: what each may drop, and what is left in the end."""

import collections

import pytest

import corpus_pipeline
from tidewheel.llm import catalog, contamination, jaccard, substrings
from tidewheel.llm.tables import read

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = read(spark, FOLDER, "documents"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = read(spark, FOLDER, "documents").columns
    assert len(stages) == 5 and all(df.columns == columns for _, df in stages[:-1])


def test_each_decision_takes_effect(spark, stages):
    benchmark = read(spark, FOLDER, "benchmark")
    near, cut, clean = (stages[i][1] for i in (1, 2, 3))
    assert jaccard.near_duplicates(near).where("n_links > 0").count() == 0
    assert substrings.remove_repeats(cut).where("n_removed > 19").count() <= substrings.remove_repeats(near).where("n_removed > 19").count()
    assert contamination.contamination(clean, benchmark).where("contaminated").count() == 0
    assert clean.count() < cut.count() <= near.count() < stages[0][1].count() < read(spark, FOLDER, "documents").count()


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert collections.Counter(map(tuple, got.select(key).collect())) == collections.Counter(map(tuple, stages[-1][1].select(key).collect()))
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in stages[3][1].collect()}


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in catalog.QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cursor = con.execute(catalog.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(map(tuple, cursor.fetchall()))
    assert sorted(map(tuple, catalog.QUERIES[name](spark, FOLDER).select(columns).collect())) == want


def test_near_copies_of_repeated_rows_and_rows_without_id(spark):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(1, text), (1, text), (2, near), (None, near), (None, "alone here and there"), (7, None), (3, "x " + text), (1, "quite another text of the same id")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, __row string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, text), (0, "alone here and there"), (7, None), (1, "quite another text of the same id")], key=str)


def test_links_of_repeated_rows_are_counted_once(spark):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    docs = spark.createDataFrame([(1, text), (1, text), (2, near)], "doc_id long, text string")
    assert [r.n_links for r in jaccard.near_duplicates(docs).collect()] == [2, 2, 2]


def _plan_nodes(df, name):
    return df._jdf.queryExecution().executedPlan().toString().count(name)


def test_plans_that_the_driver_holds_stay_small(spark):
    docs = read(spark, FOLDER, "documents")
    assert _plan_nodes(substrings.remove_repeats(docs), "MapInArrow") <= 25
    assert _plan_nodes(corpus_pipeline.drop_near_copies(spark, docs, FOLDER), "Exchange") <= 12
