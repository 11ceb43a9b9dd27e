"""Running totals: the cut form must equal the plain form and a record-by-record count."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import Fold, find_hot_keys, running_count, running_fold

SCHEMA = "k string, ts timestamp_ntz, id bigint, flag boolean"
START = dt.datetime(2024, 1, 1)


def skewed_rows(n=3000, seed=5, same_time=0.0, no_time=0.01):
    """A third of the rows under one key, some keys null, optionally many rows at one time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice([None, "a", "b", "c", "d"])
        ts = START if rng.random() < same_time else START + dt.timedelta(milliseconds=rng.randrange(10**8))
        rows.append((key, None if rng.random() < no_time else ts, i, rng.random() < 0.1))
    return rows


def by_hand(rows):
    """{id: (count, flags before, largest earlier id, flags of the key)}."""
    state, out, total = {}, {}, {}
    for k, _, _, flag in rows:
        total[k] = total.get(k, 0) + flag
    for k, _, i, flag in sorted(rows, key=lambda r: (r[1] or dt.datetime.min, r[2])):
        n, flags, top = state.get(k, (0, 0, None))
        out[i] = (n + 1, flags, top, total[k])
        state[k] = (n + 1, flags + flag, i if top is None else max(top, i))
    return out


@pytest.mark.parametrize("same_time, no_time", [(0.0, 0.01), (0.6, 0.01), (0.0, 0.6)])
@pytest.mark.parametrize("split_rows", [10**9, 500, 40])
def test_running_fold_matches_hand_count(spark, split_rows, same_time, no_time):
    rows = skewed_rows(same_time=same_time, no_time=no_time)
    df = spark.createDataFrame(rows, SCHEMA)
    hot = find_hot_keys(df, ["k"], ["ts", "id"], split_rows)
    assert (hot is None) == (split_rows == 10**9)
    if hot and same_time + no_time > 0.5:
        assert len(hot.borders) == 2  # one time holds more than a slice: cut by id as well
    flag = F.col("flag").cast("long")
    folds = [
        Fold("n", F.lit(1)),
        Fold("before", flag, inclusive=False),
        Fold("top", F.col("id"), "max", inclusive=False),
        Fold("all", flag, whole=True),
    ]
    out = running_fold(df, ["k"], ["ts", "id"], folds, hot)
    assert out.columns == ["k", "ts", "id", "flag", "n", "before", "top", "all"]
    got = {r["id"]: (r["n"], r["before"], r["top"], r["all"]) for r in out.collect()}
    assert got == by_hand(rows)


def test_a_hot_key_is_cut_into_many_groups(spark):
    from tidewheel.operators.running import _with_slices

    df = spark.createDataFrame(skewed_rows(9000, same_time=0.5), SCHEMA)
    hot = find_hot_keys(df, ["k"], ["ts", "id"], 2000)
    sliced, slices = _with_slices(df, hot)
    sizes = sliced.groupBy("k", *slices).count().collect()
    whole = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert whole["hot"] > 2800
    assert max(r["count"] for r in sizes if r["k"] == "hot") <= 2000
    assert {r["k"] for r in sizes if r["count"] == whole[r["k"]]} == {None, "a", "b", "c", "d"}


def test_running_count_of_repeated_word(spark):
    rows = [("red", 1), ("kite", 2), ("red", 3), ("red", 4), ("red", 5)]
    df = spark.createDataFrame(rows, "word string, pos int")
    got = sorted((r["pos"], r["cnt"]) for r in running_count(df, ["word"], ["pos"]).collect())
    assert got == [(1, 1), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_plain_form_shuffles_once(spark):
    df = spark.createDataFrame(skewed_rows(100), SCHEMA)
    plan = running_count(df, ["k"], ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("prefix", ["", "the-same-beginning-of-every-name/", "é" * 30])
def test_a_hot_key_is_cut_by_text_and_boolean(spark, prefix):
    from tidewheel.operators.running import _with_slices

    rng = random.Random(3)
    rows = [("hot", rng.random() < 0.5, f"{prefix}{rng.choice(['a', 'b'])}{i * 7919 % 4000:05d}", i) for i in range(4000)]
    rows += [("hot", None, None, 4000), ("hot", True, "", 4001), ("cold", True, "x", 4002)]
    df = spark.createDataFrame(rows, "k string, b boolean, s string, id bigint")
    for order in (["s", "id"], ["b", "s", "id"]):
        hot = find_hot_keys(df, ["k"], order, 500)
        out = running_fold(df, ["k"], order, [Fold("n", F.lit(1))], hot)
        got = {r["id"]: r["n"] for r in out.collect()}
        place = {"b": 1, "s": 2, "id": 3}

        def by(r):
            # nulls first, texts by their bytes
            at = [r[place[c]] for c in order]
            return [(v is not None, v.encode() if isinstance(v, str) else v or 0) for v in at]

        want = {r[3]: n + 1 for n, r in enumerate(sorted(rows[:-1], key=by))} | {4002: 1}
        assert got == want
        if len(prefix.encode()) < 40:  # texts are cut by their first 48 bytes
            sliced, slices = _with_slices(df, hot)
            assert max(r["count"] for r in sliced.where("k = 'hot'").groupBy(*slices).count().collect()) <= 1000


def test_infinite_and_missing_numbers_are_in_order(spark):
    rng = random.Random(4)
    odd = [float("inf"), float("-inf"), float("nan"), None, 0.5]
    rows = [(rng.choice(odd) if rng.random() < 0.6 else rng.random(), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "x double, id bigint").withColumn("k", F.lit("one"))
    plain = running_count(df, ["k"], ["x", "id"], split_rows=10**9)
    cut = running_count(df, ["k"], ["x", "id"], split_rows=100)
    assert sorted(cut.select("id", "cnt").collect()) == sorted(plain.select("id", "cnt").collect())


def test_no_input_goes_through_one_task(spark, monkeypatch):
    """Neither the count nor the sample has an exchange to a single partition."""
    from pyspark.sql.classic.dataframe import DataFrame

    plans, collect, to_pandas = [], DataFrame.collect, DataFrame.toPandas

    def noted(run):
        def f(self):
            plans.append(self._jdf.queryExecution().executedPlan().toString())
            return run(self)

        return f

    monkeypatch.setattr(DataFrame, "collect", noted(collect))
    monkeypatch.setattr(DataFrame, "toPandas", noted(to_pandas))
    df = spark.createDataFrame(skewed_rows(3000), SCHEMA)
    hot = find_hot_keys(df, ["k"], ["ts", "id"], 300)
    assert len(hot.hashes) > 1 and len(plans) >= 2
    running_fold(df, ["k"], ["ts", "id"], [Fold("n", F.lit(1))], hot).collect()
    assert not any("SinglePartition" in p for p in plans)
