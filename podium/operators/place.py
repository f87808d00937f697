"""Placing operators.

``distributed_rank`` is the workhorse: a row number per group that never needs one
task to see a whole group. Rows are range-partitioned on (group keys, order keys),
so a hot group is cut into many contiguous slices; each slice is numbered locally
and shifted by the row count of the slices before it (a small per-slice table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.operators.joins import join_summary, null_safe_join
from podium.operators.sketch_rank import rankable, sketch_dense_rank, sketch_rank
from podium.session import cut_lineage

Order = str | Column | tuple


def sort_col(o: Order) -> Column:
    """'x' -> x asc; ('x', 'desc') -> x desc; a Column is taken as it is."""
    if isinstance(o, Column):
        return o
    if isinstance(o, tuple):
        name, direction = o
        return F.col(name).desc() if direction == "desc" else F.col(name).asc()
    return F.col(o).asc()


def order_names(order: Sequence[Order]) -> list[str]:
    names = []
    for o in order:
        if isinstance(o, tuple):
            names.append(o[0])
        elif isinstance(o, str):
            names.append(o)
        else:
            raise TypeError("dense ranking needs column names, not expressions")
    return names


def distributed_rank(df: DataFrame, by: Sequence[str], order: Sequence[Order],
                     name: str = "place", num_partitions: int | None = None,
                     group_size: str | None = None) -> DataFrame:
    """``row_number() over (partition by <by> order by <order>)`` without a single-task window.

    The order must be total (end it with a unique key) for a reproducible result.
    ``group_size`` names an optional column with the row count of the row's group
    (the largest number handed out in it), taken from the same summary.
    Plan: one range exchange, written once as a columnar table in the shared folder (fixes
    the ranges and the local numbers, survives executor loss), and one row per slice and
    group, written and joined back; the planner broadcasts it only if its file is small.
    Without ``num_partitions`` the range bounds are cut for ``spark.sql.shuffle.partitions``
    slices and AQE may merge neighbouring small slices; merged slices stay contiguous and
    in key order, so the numbering is unchanged.
    """
    by = list(by)
    keys = [F.col(c).asc_nulls_first() for c in by] + [sort_col(o) for o in order]
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    ranged = (ranged.sortWithinPartitions(*keys)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged, "ranged")
    stats = ranged.groupBy("__pid", *by).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # at most (slices + groups) rows: each slice is a contiguous key range
    whole = Window.partitionBy(*by)
    offsets = stats.withColumns({
        "__off": F.coalesce(F.sum("__n").over(before), F.lit(0)),
        "__gn": F.sum("__n").over(whole).cast("long"),
    }).drop("__n")
    joined = join_summary(ranged, offsets, ["__pid", *by])
    out = joined.withColumn(name, (F.col("__off") + F.col("__mid") - F.col("__first") + F.lit(1)).cast("long"))
    if group_size:
        out = out.withColumn(group_size, F.col("__gn"))
    return out.drop("__pid", "__mid", "__off", "__first", "__gn")


def distributed_dense_rank(df: DataFrame, by: Sequence[str], order: Sequence[Order],
                           name: str = "place") -> DataFrame:
    """``dense_rank()`` per group: rank the distinct (group, value) rows, join back.

    The distinct table can be as large as the input, so the join back is a plain
    (shuffle) join; AQE splits a hot value on the big side.
    """
    cols = list(by) + order_names(order)
    distinct = df.select(*cols).distinct()
    ranked = distributed_rank(distinct, by, order, name)
    return null_safe_join(df, ranked, cols)


def top_one(df: DataFrame, by: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """The first row of each group by ``order`` (make the order total for a reproducible pick).

    ``row_number() <= 1`` is planned with a partial group limit before the shuffle and a
    final one after it, so each map task sends at most one row per group: a hot key is
    cut down map-side like a partial aggregate, and no sort-based aggregate is needed.
    """
    w = Window.partitionBy(*by).orderBy(*[sort_col(o) for o in order])
    return df.withColumn("__top", F.row_number().over(w)).filter(F.col("__top") == 1).drop("__top")


def window_rank(df: DataFrame, by: Sequence[str], order: Sequence[Order], name: str = "rank",
                kind: str = "row_number") -> DataFrame:
    """Plain window rank, for groups whose size is bounded by construction (e.g. a team)."""
    w = Window.partitionBy(*by).orderBy(*[sort_col(o) for o in order])
    fn = {"row_number": F.row_number, "dense_rank": F.dense_rank, "rank": F.rank}[kind]
    return df.withColumn(name, fn().over(w).cast("long"))


def place_in_division(df: DataFrame, by: Sequence[str], order: Sequence[Order],
                      name: str = "division_place") -> DataFrame:
    """Ordinal place 1..n within each division, ties broken by the order keys.

    Slices come from quantile sketches if all order columns are numbers or dates, else from a range exchange.
    """
    return (sketch_rank if rankable(df, order) else distributed_rank)(df, by, order, name)


def place_dense(df: DataFrame, by: Sequence[str], value: Order, name: str = "division_place") -> DataFrame:
    """Dense rank of a value (e.g. finish time) within each division; equal values tie.

    One shuffle of the fact if the value is a number or a date (see ``sketch_dense_rank``).
    """
    if rankable(df, [value]):
        return sketch_dense_rank(df, by, value, name)
    return distributed_dense_rank(df, by, [value], name)


def overall_place(df: DataFrame, by: Sequence[str], points: str = "series_points",
                  name: str = "overall_place") -> DataFrame:
    """1..n by points, then first name, then last name, all descending; no shared places."""
    order = [(points, "desc"), ("first_name", "desc"), ("last_name", "desc")]
    return distributed_rank(df, by, order, name)
