"""Running sums range by range, one row for each key, percentiles of wide columns."""

import random

import pytest
from pyspark.sql import functions as F

from mailposture.operators import compare, tables


@pytest.mark.parametrize("limit", [7, 1000])
def test_running_sums(spark, limit):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(0, 9)) for i in rng.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    out = {(r.k, r.at): (r.before, r.place) for r in tables.running(df, [F.col("at").asc()], {"before": F.col("v"), "place": F.lit(1)}, ["k"], limit).collect()}
    for k, at, _ in rows:
        earlier = [v for q, t, v in rows if q == k and t < at]
        assert out[k, at] == (sum(earlier), len(earlier))
    assert tables.running(df.limit(0), [F.col("at").asc()], {"before": F.col("v")}, ["k"], limit).count() == 0


def test_percentiles_do_not_depend_on_the_way(spark, monkeypatch):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice(["x", "y", None]), rng.randint(0, 400)) for _ in range(900)] + [("x", None)], "k string, v int")
    ways = []
    for most in (100_000, 20):
        monkeypatch.setattr(compare, "WINDOW_ROWS", most)
        ways.append([sorted(map(tuple, compare.percentiles(df, "v", keys).collect()), key=repr) for keys in (["k"], [])])
    assert ways[0] == ways[1] and len(ways[0][0]) == 3
    values = sorted(r.v for r in df.filter("v is not null").collect())
    assert ways[0][1][0][:4] == (900, (values[449] + values[450]) // 2, values[810], values[-1])


def test_least_row(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, None, 3), (2, "x", 1)], "k int, a string, b int")
    assert sorted(map(tuple, tables.least_row(df, ["k"]).collect())) == [(1, "a", 2), (2, None, 3)]
    assert tables.least_row(df, ["k"], []).count() == 2
    assert tables.must_be_short(df).count() == 4
    with pytest.raises(ValueError, match="patterns"):
        tables.must_be_short(df, 3)
