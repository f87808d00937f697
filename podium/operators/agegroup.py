"""Age-group winners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.text import full_name
from podium.operators.quality import raise_if_any
from podium.rules import AGE_BANDS, PODIUM_SIZE, REPORT_SENTINEL
from podium.schema import AGE_BANDS as AGE_BANDS_SCHEMA


def age_bands(spark: SparkSession, bands=AGE_BANDS) -> DataFrame:
    """The band table: (lower, upper, 'lower-upper'), both bounds inclusive."""
    rows = [(lo, hi, f"{lo}-{hi}") for lo, hi in bands]
    return spark.createDataFrame(rows, AGE_BANDS_SCHEMA)


def collect_ages(points: DataFrame, keys: Sequence[str] = ("division",)) -> DataFrame:
    """A1: every known age of every racer over all events (participation rows carry none; the
    report sentinel is no age)."""
    return (points.filter(F.col("age").isNotNull() & (F.col("age") != F.lit(REPORT_SENTINEL)))
            .select(*keys, full_name("first_name", "last_name").alias("name"),
                    F.col("age").cast("long").alias("age")))


def modal_age(ages: DataFrame, keys: Sequence[str] = ("division", "name")) -> DataFrame:
    """A2: most frequent age per racer; on a tie the lowest age. Two partial aggregates."""
    counted = ages.groupBy(*keys, "age").agg(F.count(F.lit(1)).alias("__n"))
    return (counted.groupBy(*keys)
            .agg(F.max_by("age", F.struct(F.col("__n"), -F.col("age"))).alias("age")))


def exclude_podium(standings: DataFrame, k: int = PODIUM_SIZE, place: str = "overall_place") -> DataFrame:
    """A3: leave out the overall top k."""
    return standings.filter(F.col(place) > F.lit(k))


def _binned(bands: DataFrame, width: int) -> DataFrame:
    """Each band once per bin of ``width`` that it meets; bands without a value are left out."""
    bins = F.sequence(F.floor(F.col("lower") / width), F.floor(F.col("upper") / width))
    return bands.filter(F.col("lower") <= F.col("upper")).withColumn("__bin", F.explode(bins))


def _bin_width(bands: DataFrame) -> int:
    """The mean width of a band: then a band meets about two bins, and bins hold few bands."""
    mean = bands.filter(F.col("lower") <= F.col("upper")).agg(F.avg(F.col("upper") - F.col("lower") + 1)).first()[0]
    return max(1, int(mean or 1))


def overlapping_bands(bands: DataFrame, width: int | None = None) -> DataFrame:
    """Bands that begin before an earlier one ends. Two bands that overlap share a bin, so each bin is
    looked at by itself; no pairs are made."""
    width = width or _bin_width(bands)
    before = Window.partitionBy("__bin").orderBy("lower", "upper").rowsBetween(Window.unboundedPreceding, -1)
    found = _binned(bands, width).withColumn("__reach", F.max("upper").over(before))
    return found.filter(F.col("lower") <= F.col("__reach")).drop("__bin", "__reach").distinct()


def band_join(df: DataFrame, bands: DataFrame, age: str = "age", overlaps: str = "raise") -> DataFrame:
    """A5: range join to the band whose [lower, upper] holds the age, as an equi-join on bins.

    Bands are listed under the bins of mean band width that they meet and a value looks into its
    own bin, so a table of any number of bands works: the planner broadcasts it if it is small and shuffles
    otherwise. Bands that overlap would double rows: they raise, or with ``overlaps="allow"`` give a row per band.
    """
    width = _bin_width(bands)
    if overlaps == "raise":
        raise_if_any(overlapping_bands(bands, width), "bands overlap")
    elif overlaps != "allow":
        raise ValueError(f"overlaps must be 'raise' or 'allow', not {overlaps!r}")
    listed = _binned(bands, width)
    own = df.withColumn("__bin", F.floor(F.col(age) / width))
    hit = own.join(listed, "__bin").filter((F.col(age) >= F.col("lower")) & (F.col(age) <= F.col("upper")))
    return hit.drop("__bin", "lower", "upper")


def first_per_group(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Per group, the row with the smallest ``order`` value (ties: smallest row)."""
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(F.col(order), *cols)).alias("__w"))
    return best.select(*keys, "__w.*")


def age_group_winners(standings: DataFrame, ages: DataFrame, bands: DataFrame,
                      keys: Sequence[str] = ("division",), k: int = PODIUM_SIZE) -> DataFrame:
    """Best overall place per (division, band), outside the overall top k."""
    eligible = exclude_podium(standings, k).select(*keys, "name", "overall_place")
    with_age = eligible.join(ages, [*keys, "name"], "inner")
    banded = band_join(with_age, bands)
    return first_per_group(banded, [*keys, "age_group"], "overall_place", ["name", "overall_place"])
