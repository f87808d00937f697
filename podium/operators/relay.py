"""Relay results (L1-L2): a team row becomes one row per member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.text import rstrip_chars
from podium.operators.joins import null_safe_join


def relay_stretch(df: DataFrame, name_cols: Sequence[str], strip: str = "&") -> DataFrame:
    """L1: one row per member name cell; the team's other columns (time, class) repeat.

    Name cells are trimmed and lose trailing ``strip`` characters ('A B &' -> 'A B').
    """
    keep = [c for c in df.columns if c not in name_cols]
    members = F.array(*[F.struct(F.lit(i + 1).alias("member_no"), F.col(c).alias("member_name"))
                        for i, c in enumerate(name_cols)])
    out = df.select(*keep, F.explode(members).alias("__m"))
    return out.select(*keep, "__m.member_no",
                      rstrip_chars(F.col("__m.member_name"), strip).alias("member_name"))


def relay_division(df: DataFrame, class_col: str, lookup: DataFrame,
                   class_map: Mapping[str, str], name_col: str = "member_name") -> DataFrame:
    """L2: the team class gives the division; a mixed class looks each member up by name.

    ``class_map`` maps class text to a division; other classes use ``lookup``
    (name, division; of several divisions of a name the first in order); the planner broadcasts it when its files are small, else shuffles.
    """
    lk = lookup.groupBy(F.col("name").alias("__lk_name")).agg(F.min("division").alias("__lk_division"))
    joined = df.join(lk, df[name_col] == lk["__lk_name"], "left")
    mapped = None
    for cls, div in class_map.items():
        cond = F.col(class_col) == F.lit(cls)
        mapped = F.when(cond, F.lit(div)) if mapped is None else mapped.when(cond, F.lit(div))
    division = mapped.otherwise(F.col("__lk_division")) if mapped is not None else F.col("__lk_division")
    return joined.withColumn("division", division).drop("__lk_name", "__lk_division")


def lookup_division(df: DataFrame, lookup: DataFrame, keys: Sequence[str], name: str = "division") -> DataFrame:
    """Division by lookup (left join on ``keys``; null where the lookup has none).

    A key that the lookup lists more than once gives one row: its first division in order, so
    no row is doubled. The planner broadcasts the lookup when it is small, else it shuffles.
    """
    one = lookup.groupBy(*keys).agg(F.min(name).alias(name))
    return null_safe_join(df, one, list(keys), "left")
