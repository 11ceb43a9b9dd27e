"""The registered queries against the same question in SQL on another engine, on the small tables."""

import glob
import os

import pytest

import __spark_entry__ as contract
from tidewheel.plans import catalog
from check_oracles import table

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(contract.queries())


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.dtypes == [("word", "string"), ("cnt", "bigint")]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, FOLDER)
    rows = df.collect()
    cursor = sql.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, rows) == table(columns, cursor.fetchall())
    assert rows


def test_a_key_of_a_micro_batch_fits_the_memory_of_a_task():
    """F2: before, 1 GB of files a micro-batch, whose rows are 250 bytes each in memory and 20 on disk."""
    assert int(catalog.STATEFUL_LIMITS["maxBytesPerTrigger"]) / 20 * 250 < 1000e6
