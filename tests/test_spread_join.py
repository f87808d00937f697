"""Joins whose hot keys are spread over all tasks: equal results, no hot task."""

import pytest
from pyspark.sql import functions as F

from podium.operators.joins import hot_keys, spread_join


@pytest.fixture(scope="module")
def sides(spark):
    # a third of the rows carry a blank name, a tenth a null one
    left = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 10 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("n"), (F.col("id") % 5000).cast("string"))).alias("first_name"), F.lit("x").alias("last_name"))
    right = spark.createDataFrame([("", "x", 1), ("", "x", 2), ("n7", "x", 3), ("n8", "y", 4), (None, "x", 5)],
                                  "first_name string, last_name string, team int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equal_to_a_plain_join(sides, how):
    left, right = sides
    keys = ["first_name", "last_name"]
    got, want = spread_join(left, right, keys, how), left.join(right, keys, how)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_names_are_found_and_spread(spark, sides):
    left, right = sides
    keys = ["first_name", "last_name"]
    assert '{"first_name":"","last_name":"x"}' in hot_keys(left, keys, 0.2) and len(hot_keys(left, keys, 0.2)) == 1
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for join, most in ((left.join(right, keys), 20_000), (spread_join(left, right, keys), 5000)):
            sizes = join.groupBy(F.spark_partition_id()).count().collect()
            assert (max(r["count"] for r in sizes) >= most) == (most == 20_000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_odd_input(sides):
    left, right = sides
    assert spread_join(left.limit(0), right, ["first_name", "last_name"]).count() == 0
    with pytest.raises(ValueError):
        spread_join(left, right, ["first_name"], "full")
