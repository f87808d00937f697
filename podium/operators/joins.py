"""Join helpers: summaries of known size and null-safe equi-joins.

``spread_join`` salts the hot keys of a large side. Two kinds of small sides occur:

* dimension tables read from files (aliases, adjustments, lookups): joined plainly; the
  planner sizes them from file statistics and broadcasts only below
  ``spark.sql.autoBroadcastJoinThreshold``, else it shuffles (sort-merge join).
* summaries derived inside a job (field size per group, row counts per range slice): the
  planner cannot size them, so they are written to the shared folder first and joined like
  a dimension table. No row reaches the driver and no row count switches the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.session import cut_lineage

HOT_KEYS, TRACKED = 64, 4096  # keys that can be salted, counters of the sketch


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null; keeps one copy of each key column."""
    renamed = {k: f"__r_{k}" for k in keys}
    r = right.withColumnsRenamed(renamed)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[v]) for k, v in renamed.items()])
    return left.join(r, cond, how).drop(*renamed.values())


def join_summary(df: DataFrame, summary: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Attach a per-group summary to ``df`` (null-safe on keys); it is computed once."""
    return null_safe_join(df, cut_lineage(summary, "summary"), keys, how)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> list[str]:
    """Key values (as JSON text) that hold more than ``share`` of the rows: at most HOT_KEYS.

    One aggregate with a mergeable heavy-hitter sketch; only its top entries reach the driver. An
    estimate may be high, never low, by the sketch's error, so a key is at worst salted in vain.
    """
    found = df.select(F.to_json(F.struct(*keys)).alias("__key")).agg(
        F.expr(f"approx_top_k(__key, {HOT_KEYS}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in found["top"] or () if x["count"] > share * found["n"]]


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                share: float | None = None) -> DataFrame:
    """Equi-join on ``keys`` (one copy kept) whose hot keys of ``left`` are spread over all tasks.

    A heavy-hitter sketch over the left keys finds those that hold more than a task's part of the rows
    (``share``, by default 1 / shuffle partitions). Their rows get a salt by hash and the right
    rows of these keys alone are repeated per salt; all other keys join as ever. A blank name that a third of
    the rows carry is the real case. Inner, left and left semi or anti joins; a null key matches nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join does not do a {how!r} join")
    keys = list(keys)
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, keys, 1 / parts if share is None else share)
    if not hot:
        return left.join(right, keys, how)
    n = 4 * parts  # several salts a task, so that tasks come out even
    own = [F.col(c) for c in left.columns if not isinstance(left.schema[c].dataType, (T.MapType, T.VariantType))]
    is_hot = F.to_json(F.struct(*keys)).isin(*hot)
    salted = left.withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(*own), F.lit(n))).otherwise(F.lit(0)).cast("int"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(right.withColumn("__salt", F.explode(salts)), [*keys, "__salt"], how).drop("__salt")
