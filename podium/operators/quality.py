"""Data quality (Q1-Q4): aliases, duplicate finders, quarantine, completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.operators.joins import spread_join


def find_duplicates(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Q2 (F2, T2, E9): keys that occur more than once, with their count.

    An aggregate (partial map-side), returned as a table: a guard reports all
    offenders instead of failing on the first row.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
            .filter(F.col(name) > 1))


def raise_if_any(offenders: DataFrame, message: str, show: int = 20) -> None:
    """Fail with a bounded sample of offenders (only ``show`` rows reach the driver)."""
    sample = offenders.take(show)
    if sample:
        raise ValueError(f"{message}: {[r.asDict() for r in sample]}")


def alias_report(points: DataFrame, aliases: DataFrame, keys: Sequence[str] = ("event", "division"),
                 case_insensitive: bool = False, spread: bool = False) -> DataFrame:
    """Q1: scored rows whose name is a known alias, with the preferred name.

    Names match exactly by default; ``case_insensitive`` compares lower-cased names
    (results sometimes carry a lower-case name). ``spread`` deals names that hold a large share
    of the rows over all tasks.
    """
    norm = F.lower if case_insensitive else (lambda c: c)
    a = aliases.select(norm(F.col("alias_fn")).alias("__fn"), norm(F.col("alias_ln")).alias("__ln"), "actual_fn", "actual_ln")
    named = points.withColumns({"__fn": norm(F.col("first_name")), "__ln": norm(F.col("last_name"))})
    hits = spread_join(named, a, ["__fn", "__ln"]) if spread else named.join(a, ["__fn", "__ln"])
    extra = [c for c in ("division_place", "age") if c in points.columns]
    return hits.select(*keys, "first_name", "last_name", "actual_fn", "actual_ln", *extra)


def quarantine(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Q3: split rows into (clean, rejected); rejected rows carry the first failing reason."""
    reason = None
    for label, bad in reasons.items():
        reason = (F.when(bad, F.lit(label)) if reason is None
                  else reason.when(bad, F.lit(label)))
    tagged = df.withColumn("reject_reason", reason)
    clean = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.filter(F.col("reject_reason").isNotNull())
    return clean, rejected


def reason_counts(df: DataFrame, reasons: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Q3 side output: rows per reject reason ('ok' for clean rows), one aggregate pass."""
    reason = None
    for label, bad in reasons.items():
        reason = (F.when(bad, F.lit(label)) if reason is None
                  else reason.when(bad, F.lit(label)))
    tagged = df.withColumn("reason", F.coalesce(reason, F.lit("ok")))
    return tagged.groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def guard_partition(df: DataFrame, col: str, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Q4: completeness per group: rows, rows per listed value, and whether they add up."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for v in values:
        aggs.append(F.count(F.when(F.col(col) == F.lit(v), F.lit(1))).alias(f"n_{v}"))
    out = df.groupBy(*keys).agg(*aggs)
    total = sum((F.col(f"n_{v}") for v in values), F.lit(0))
    return out.withColumn("complete", total == F.col("n_rows"))
