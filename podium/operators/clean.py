"""Filters, projections and cleaning (P1-P11) plus race union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.rules import STATUS_CODES

KNOWN_DIVISIONS = ("male", "female", "nb")


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose columns are all non-null."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def drop_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose text columns are non-null and not blank after trimming."""
    return df.filter(reduce(lambda a, b: a & b,
                            [F.trim(F.col(c).cast("string")) != "" for c in cols]))


def drop_status(df: DataFrame, col: str, codes: Sequence[str] = STATUS_CODES) -> DataFrame:
    """Drop non-finisher rows (place text DNS, DNF, *)."""
    c = F.trim(F.col(col))
    return df.filter(c.isNull() | ~c.isin(*codes))


def tag_race_role(df: DataFrame, race_col: str, main_races: Sequence[str]) -> DataFrame:
    """P4: 'main' for the listed races, 'participation' for every other race."""
    return df.withColumn("race_role", F.when(F.col(race_col).isin(*main_races), F.lit("main"))
                         .otherwise(F.lit("participation")))


def resolve_columns(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """P5: map headers case-insensitively and trimmed to canonical names.

    ``wanted`` maps a canonical name to its expected header text. Raises with the
    full list of missing headers. Schema-only work: no data is read.
    """
    index = {c.strip().lower(): c for c in df.columns}
    missing = [h for h in wanted.values() if h.strip().lower() not in index]
    if missing:
        raise ValueError(f"missing required columns: {missing}; found {df.columns}")
    return df.select(*[F.col(f"`{index[h.strip().lower()]}`").alias(k) for k, h in wanted.items()])


def patch_rows(df: DataFrame, cond: Column, col: str, value) -> DataFrame:
    """Set one cell where a predicate on the row holds."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(cond, v).otherwise(F.col(col)))


def to_results(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Canonical projection: target name -> source column or expression."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing numbers become 0 (report form)."""
    return df.fillna(0, subset=list(cols))


def quarantine_unknown_division(df: DataFrame, col: str = "division",
                                known: Sequence[str] = KNOWN_DIVISIONS) -> tuple[DataFrame, DataFrame]:
    """Rows with an unreadable division go to a side output instead of vanishing."""
    ok = F.col(col).isin(*known)
    return df.filter(ok), df.filter(~ok | F.col(col).isNull())


def union_races(frames: Sequence[DataFrame], races: Sequence[str] | None = None) -> DataFrame:
    """Stack several races of one event; columns missing in a race become null."""
    tagged = []
    for i, f in enumerate(frames):
        if races is not None:
            f = f.withColumn("race", F.lit(races[i]))
        tagged.append(f)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
