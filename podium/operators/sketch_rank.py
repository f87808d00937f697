"""Ranks whose slices come from quantile sketches.

A group is cut into slices of consecutive values at the quantiles of a mergeable sketch per group
(one aggregate that combines map-side, whatever the group's size). A row finds its slice by binary
search in its group's array of edges; rows are hashed by (group, slice), numbered inside their slice by an
ordinary window, and shifted by the rows of the slices before. The sketch's error only moves the
edges: the numbers do not depend on it.

A value that fills whole slices by itself (a floor score, say) gets a slice of its own. Such a
slice is cut by the next order column in the same way; rows that are equal in all order columns are
dealt by a hash, as any order among them is right.

Order columns must be numbers, dates, timestamps or booleans: ``rankable`` tells. Nulls come
first in ascending and last in descending order, NaN is the largest value, as in Spark's sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.operators.joins import null_safe_join
from podium.session import cut_lineage

SLICE_ROWS = 1 << 20
SKETCH_SIZE = 4000  # about 0.1 % rank error
MOST_SLICES = 4096  # of a group and order column: finer cuts are beyond the sketch
STEPS = 31  # of a binary search, enough for any array
_LOW, _HIGH = -1, (1 << 31) - 2


def _sides(order) -> list[tuple[str, bool]]:
    """(column, descending) of 'x' and ('x', 'asc' or 'desc')."""
    return [(o, False) if isinstance(o, str) else (o[0], o[1] == "desc") for o in order]


def _number(df: DataFrame, name: str) -> tuple[Column, str] | None:
    """The column as a double or bigint that orders its values exactly; None if there is none."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return c.cast("double"), "double"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("bigint"), "bigint"
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint"), "bigint"
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c), "bigint"
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (c * F.lit(10 ** kind.scale).cast("decimal(19,0)")).cast("bigint"), "bigint"
    return None


def rankable(df: DataFrame, order: Sequence) -> bool:
    """Whether all order columns are plain columns of a type that a sketch takes."""
    return all((isinstance(o, (str, tuple)) and _number(df, _sides([o])[0][0]) is not None) for o in order)


def _below(edges: Column, value: Column) -> Column:
    """How many of the sorted edges are less than ``value``: binary search by a fold of fixed length."""
    def step(bounds, _):
        middle = F.shiftright(bounds["low"] + bounds["high"], 1)
        less = F.get(edges, middle) < value
        return F.when(bounds["low"] >= bounds["high"], bounds).otherwise(F.struct(
            F.when(less, middle + 1).otherwise(bounds["low"]).alias("low"),
            F.when(less, bounds["high"]).otherwise(middle).alias("high")))

    start = F.struct(F.lit(0).alias("low"), F.size(edges).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.least(F.lit(STEPS), F.ceil(F.log2(F.size(edges) + F.lit(1.0))).cast("int") + 1)),
                       start, step, lambda b: b["low"])


def _edges(df: DataFrame, by: Sequence[str], value: Column, kind: str, slice_rows: int) -> DataFrame:
    """(by..., __edges, __times, __odd): sorted edges per group, of how many quantiles each is the
    value, and how many slices the group's nulls and NaN fill (0: not even one)."""
    spark = df.sparkSession
    most = min(MOST_SLICES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sketch = getattr(F, f"kll_sketch_agg_{kind}")
    quantile = getattr(F, f"kll_sketch_get_quantile_{kind}")
    clean = F.when(~F.isnan(value), value) if kind == "double" else value
    groups = df.groupBy(*by).agg(sketch(clean, F.lit(SKETCH_SIZE)).alias("__sketch"),
                                 F.count(clean).alias("__rows"), F.count(F.lit(1)).alias("__all_rows"))
    # the ranks must be a constant: every group's quantiles are a choice from one ladder
    ladder = F.split(F.lit(",".join(str(i / most) for i in range(1, most))), ",").cast("array<double>")
    n = F.least(F.ceil(F.col("__rows") / F.lit(float(slice_rows))), F.lit(most)).cast("int")
    picked = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(2)) - 1),
                         lambda i: F.get("__all", F.floor(i * F.lit(most) / n).cast("int") - 1))
    groups = groups.withColumns({"__all": F.when(n > 1, quantile("__sketch", ladder)), "__n": n})
    found = F.when(n > 1, picked).otherwise(F.array().cast(f"array<{kind}>"))
    odd = F.ceil((F.col("__all_rows") - F.col("__rows")) / F.lit(float(slice_rows))).cast("int")
    groups = cut_lineage(groups.select(*by, found.alias("__q"), F.when(odd > 1, odd).otherwise(F.lit(0)).alias("__odd")),
                         "edges")
    edges = F.array_distinct("__q")
    times = F.transform(edges, lambda e: F.size(F.filter("__q", lambda q: q == e)))
    return groups.select(*by, edges.alias("__edges"), times.alias("__times"), "__odd")


def _sliced(df: DataFrame, by: Sequence[str], column: str, descending: bool, level: int,
            slice_rows: int) -> tuple[DataFrame, bool]:
    """``df`` with ``__s<level>`` (slices in order) and ``__n`` (0, or into how many a slice of one
    value is to be cut), and whether there is any to cut.

    Slices are 2p for the values between edges, 2p + 1 for an edge's value that fills slices alone.
    """
    value, kind = _number(df, column)
    value = F.bitwise_not(value) if descending and kind == "bigint" else -value if descending else value
    open_ = F.col("__n") > 0 if level else F.lit(True)
    edges = _edges(df.filter(open_) if level else df, by, value, kind, slice_rows)
    heavy = bool(edges.filter((F.col("__odd") > 0) | F.exists("__times", lambda t: t > 1)).take(1))
    joined = null_safe_join(df, edges, list(by), "left") if by else df.join(edges, F.lit(True), "left")
    p = _below(F.col("__edges"), value)
    alone = (F.get("__edges", p) == value) & (F.get("__times", p) > 1)
    odd = value.isNull() | (F.isnan(value) if kind == "double" else F.lit(False))
    high = value.isNull() if descending else value.isNotNull()  # nulls last, or NaN
    number = F.when(odd, F.when(high, F.lit(_HIGH)).otherwise(F.lit(_LOW))).otherwise(
        2 * p + F.coalesce(alone, F.lit(False)).cast("int"))
    into = F.when(odd, F.col("__odd")).when(alone, F.get("__times", p) + 1).otherwise(F.lit(0))
    return joined.withColumns({f"__s{level}": F.when(open_, number).otherwise(F.lit(0)).cast("int"),
                               "__n": F.when(open_, into).otherwise(F.lit(0)).cast("int")}).drop(
        "__edges", "__times", "__odd"), heavy


def _slices(df: DataFrame, by: Sequence[str], order: Sequence, slice_rows: int) -> tuple[DataFrame, list[str]]:
    """``df`` with its slice columns, and their names. Rows of one slice of one value that no
    order column tells apart are dealt by a hash (``__salt``)."""
    own = [F.col(c) for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    names: list[str] = []
    for level, (column, descending) in enumerate(_sides(order)):
        df, heavy = _sliced(df, [*by, *names], column, descending, level, slice_rows)
        names.append(f"__s{level}")
        if not heavy:
            break
    salt = F.when(F.col("__n") > 0, F.pmod(F.xxhash64(*own), F.col("__n"))).otherwise(F.lit(0)).cast("int")
    return df.withColumn("__salt", salt).drop("__n"), [*names, "__salt"]


def _order(order: Sequence) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c, descending in _sides(order)]


def sketch_rank(df: DataFrame, by: Sequence[str], order: Sequence, name: str = "place",
                slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``row_number() over (partition by <by> order by <order>)``: the fact is shuffled once and not written.

    The scan runs once per order column for the sketches (later columns only if a value of the ones before
    fills slices), once to count the slices and once for the rows; only the tables of edges and
    of slices are written.
    """
    by = list(by)
    sliced, slices = _slices(df, by, order, slice_rows)
    before = Window.partitionBy(*by).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(*by, *slices).agg(F.count(F.lit(1)).alias("__rows"))
    offsets = cut_lineage(counts.withColumn("__off", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows"), "offsets")
    inside = Window.partitionBy(*by, *slices).orderBy(*_order(order))
    joined = null_safe_join(sliced, offsets, [*by, *slices])
    return (joined.withColumn(name, (F.row_number().over(inside) + F.col("__off")).cast("long"))
            .drop("__off", *slices))


def sketch_dense_rank(df: DataFrame, by: Sequence[str], value, name: str = "place",
                      slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``dense_rank() over (partition by <by> order by <value>)`` with one shuffle of the fact.

    Equal values share a slice, so a rank is the one inside the slice plus the number of distinct values in
    the slices before: the largest rank inside each. A slice of one value holds one, however
    it is dealt out.
    """
    by = list(by)
    sliced, slices = _slices(df, by, [value], slice_rows)
    inside = Window.partitionBy(*by, *slices).orderBy(*_order([value]))
    ranked = cut_lineage(sliced.withColumn("__own", F.dense_rank().over(inside)), "ranked")
    distinct = ranked.groupBy(*by, "__s0").agg(F.max("__own").alias("__values"))
    before = Window.partitionBy(*by).orderBy("__s0").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(distinct.withColumn("__off", F.coalesce(F.sum("__values").over(before), F.lit(0)))
                          .drop("__values"), "offsets")
    return (null_safe_join(ranked, offsets, [*by, "__s0"])
            .withColumn(name, (F.col("__own") + F.col("__off")).cast("long")).drop("__own", "__off", *slices))
