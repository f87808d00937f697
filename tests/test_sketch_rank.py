"""Ranks with slices from quantile sketches against the plain window functions."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from podium.operators.sketch_rank import rankable, sketch_dense_rank, sketch_rank


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    nan = float("nan")
    data = []
    for i in range(6000):
        g = rng.choice(["a", "a", "a", "b", None]) if i else "lone"
        v = 20.0 if rng.random() < 0.4 else rng.choice([nan, None, -0.0, 0.0, round(rng.gauss(0, 50), 1)])
        n = rng.choice([None, 7, 7, 7, -(1 << 63), (1 << 63) - 1, rng.randrange(-500, 500)])
        day = None if rng.random() < 0.05 else dt.date(1960, 1, 1) + dt.timedelta(rng.randrange(30000))
        data.append((i, g, v, n, day))
    return spark.createDataFrame(data, "id long, g string, v double, n long, day date").repartition(7).cache()


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("order", [["v", "id"], [("v", "desc"), "id"], [("n", "desc"), ("v", "asc"), ("id", "desc")],
                                   ["day", "n", "id"], ["id"]])
def test_row_numbers(spark, rows, by, order):
    sides = [(o, "asc") if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*by).orderBy(*[F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in sides])
    got = sketch_rank(rows, by, order, "place", slice_rows=50)
    assert got.columns == [*rows.columns, "place"]
    want = rows.withColumn("place", F.row_number().over(w).cast("long"))
    assert sorted(map(str, got.select("id", "place").collect())) == sorted(map(str, want.select("id", "place").collect()))


@pytest.mark.parametrize("by, value", [(["g"], "v"), (["g"], ("n", "desc")), ([], ("day", "asc")), ([], ("v", "desc"))])
def test_dense_ranks(spark, rows, by, value):
    name, side = (value, "asc") if isinstance(value, str) else value
    w = Window.partitionBy(*by).orderBy(F.col(name).desc() if side == "desc" else F.col(name).asc())
    got = sketch_dense_rank(rows, by, value, "place", slice_rows=50).select("id", "place").collect()
    want = rows.select("id", F.dense_rank().over(w).cast("long").alias("place")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_equal_rows_get_all_numbers(spark):
    df = spark.range(3000).select(F.lit(5).alias("v"), F.lit("x").alias("t"))
    got = sketch_rank(df, ["t"], ["v"], slice_rows=100).select("place").collect()
    assert sorted(r.place for r in got) == list(range(1, 3001))
    assert {r.place for r in sketch_dense_rank(df, ["t"], "v", slice_rows=100).collect()} == {1}


def test_a_floor_value_is_spread_over_tasks(spark):
    """Half of all rows share the value: no partition holds them all."""
    df = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, 20.0).otherwise(F.col("id") / 7).alias("v"))
    sizes = (sketch_rank(df, [], ["v", "id"], slice_rows=1000).filter("v = 20.0")
             .groupBy(F.spark_partition_id()).count().collect())
    assert sum(r["count"] for r in sizes) >= 20_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = (sketch_rank(df, [], ["v", "id"], slice_rows=1000).filter("v = 20.0")
                 .groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 12_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_types_and_empty_tables(spark, rows):
    assert rankable(rows, ["v", ("n", "desc"), "day"]) and not rankable(rows, ["g"]) and not rankable(rows, [F.col("v")])
    dec = spark.sql("SELECT cast(id / 8 AS decimal(12,3)) d, timestamp_seconds(id) t, id % 2 = 0 b, cast(id AS int) i FROM range(300)")
    for c in dec.columns:
        got = {r.i: r.place for r in sketch_rank(dec, [], [(c, "desc"), "i"], slice_rows=20).collect()}
        want = {r.i: r.p for r in dec.withColumn("p", F.row_number().over(Window.orderBy(F.col(c).desc(), "i"))).collect()}
        assert got == want
    assert sketch_rank(rows.limit(0), ["g"], ["v", "id"]).count() == 0
    assert sketch_dense_rank(rows.limit(0), [], "v").count() == 0
