import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewheel.operators import running_words, split_words, tokenize
from tidewheel.operators.running import in_blocks
from tidewheel.plans import jobs

ODD = [None, "", " ", "-- ...", " Ox,\tox\x0bOX \n", "İ K i k", "a\u0085b c a", "don't dont", "été t", "ox  "]


def _by_window(lines, order, plain):
    words = (split_words if plain else tokenize)(lines, "value", order, "position")
    so_far = Window.partitionBy("word").orderBy(*order, "position")
    return words.withColumn("cnt", F.row_number().over(so_far).cast("long"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("order", [["id"], ["place", "id"]])
def test_running_words_go_on_from_block_to_block(spark, plain, order):
    """Lines of any order, in many blocks, some by the fifth byte of a text or a later column."""
    rows = [(i, [None, "", "line", "line by line"][i % 4], f"the {ODD[i % 10] or ''} w{i % 7} The") for i in range(400)]
    rows += [(1000 + i, "line", text) for i, text in enumerate(ODD)]
    lines = spark.createDataFrame(rows, "id long, place string, value string").repartition(5, F.xxhash64("id"))
    _, _, blocks = in_blocks(lines, order, F.lit(10), 200)
    assert blocks > 10
    for size in (200, 1 << 20):
        got = running_words(lines, order, plain=plain, block_bytes=size)
        assert got.columns == [*order, "position", "word", "cnt"]
        assert _rows(got) == _rows(_by_window(lines, order, plain))


def test_running_words_of_no_lines_and_of_an_order_that_is_not_cut(spark):
    lines = spark.createDataFrame([([2], "ox elk"), ([1], "ox")], "at array<int>, value string")
    assert _rows(running_words(lines, ["at"])) == [([1], 0, "ox", 1), ([2], 0, "ox", 2), ([2], 1, "elk", 1)]
    assert running_words(spark.createDataFrame([], "id long, value string"), ["id"]).collect() == []


def test_words_of_a_running_count_are_not_shuffled(spark):
    """Only lines, and a row for each block and word, are: 20,000 words, ten different ones."""
    lines = spark.range(2000).select("id", F.expr("concat_ws(' ', transform(sequence(0, 9), i -> concat('w', i)))").alias("value"))
    counted = jobs.running_word_count(lines, ["id"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    assert counted.where("cnt = 2000 and id = 1999").count() == 10
