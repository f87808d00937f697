"""Season standings for individuals.

A chain of full outer joins (one per event, one wide column each) becomes a single grouped
aggregate over the long event-points table: one shuffle, partial aggregation
map-side, per-event columns by conditional aggregation with a fixed event list.

    series = sum(best k event points) + step incentive(n events) + adjustment
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.numbers import round_half_up, step_bonus, to_units
from podium.functions.text import full_name
from podium.operators.place import overall_place
from podium.rules import CURRENT, ScoringRules

RACER_KEYS = ("division", "first_name", "last_name")


def event_column(event) -> str:
    """Wide column of an event: ``<event>_points`` (numeric events get an ``e`` prefix)."""
    return f"e{event}_points" if isinstance(event, int) else f"{event}_points"


def best_k_sum(points_list: Column, k: int, decimals: int = 6) -> Column:
    """Exact sum of the k largest values of an array (integer units, order-free)."""
    top = F.slice(F.sort_array(points_list, asc=False), 1, k)
    units = F.aggregate(top, F.lit(0).cast("bigint"), lambda acc, x: acc + to_units(x, decimals))
    return units / F.lit(float(10 ** decimals))


def season_points(points: DataFrame, rules: ScoringRules = CURRENT,
                  keys: Sequence[str] = RACER_KEYS, events: Sequence | None = None) -> DataFrame:
    """two partial aggregates, per (racer, event), then per racer.

    ``n_events`` counts events with points (participation counts), ``best_points`` is
    the exact sum of the best ``rules.best_k``, ``incentive`` the cumulative step bonus.
    The first aggregate keeps one value per racer and event (the higher one if a name
    appears twice, which the unique-racer guard F2 reports), so the points list of a
    racer is bounded by the event list even when one key (say, blank names) holds a
    large share of all rows; both aggregates combine map-side before their shuffle.
    With ``events`` given, only they count, one ``e<event>_points`` column per event is added
    (null where the racer has no points), and the best k are taken from those columns.
    """
    if events is not None:
        points = points.filter(F.col("event").isin(*events))
    points = points.groupBy(*keys, "event").agg(F.max("points").alias("points"))
    aggs = [
        F.count("points").alias("n_events"),
        *([F.collect_list("points").alias("__pts")] if events is None else []),
        (F.sum(to_units("points", rules.precision)) / F.lit(float(10 ** rules.precision))).alias("all_points"),
    ]
    for e in events or ():
        aggs.append(F.max(F.when(F.col("event") == F.lit(e), F.col("points"))).alias(event_column(e)))
    agg = points.groupBy(*keys).agg(*aggs)
    listed = F.col("__pts") if events is None else F.filter(
        F.array(*[F.col(event_column(e)) for e in events]).cast("array<double>"), lambda x: x.isNotNull())
    best = best_k_sum(listed, rules.best_k, rules.precision)
    incentive = step_bonus("n_events", rules.steps)
    return (agg.withColumns({"best_points": best, "incentive": incentive})
            .withColumn("series_points", F.col("best_points") + F.col("incentive"))
            .drop("__pts"))


def apply_adjustments(season: DataFrame, adjustments: DataFrame,
                      keys: Sequence[str] = ("first_name", "last_name")) -> DataFrame:
    """add a manual adjustment (left join, missing -> 0) after best-k and incentives."""
    adj = (adjustments.groupBy(*keys)
           .agg(F.sum(F.col("bias_adjustment").cast("double")).alias("adjustment")))
    joined = season.join(adj, list(keys), "left")  # planner broadcasts it when small
    adjustment = F.coalesce(F.col("adjustment"), F.lit(0.0))
    return joined.withColumns({"adjustment": adjustment,
                               "series_points": F.col("series_points") + adjustment})


def standings_wide(season: DataFrame, events: Sequence, by: Sequence[str] = ("division",),
                   decimals: int = 2) -> DataFrame:
    """the report form: place, full name, events, rounded totals, one column per event.

    Event columns absent for a racer (or for the whole season) are 0. The place is
    given on the unrounded total: points, first name, last name, all descending.
    """
    placed = overall_place(season, by, "series_points", "overall_place")
    cols = {"name": full_name("first_name", "last_name"),
            "series_points": round_half_up("series_points", decimals)}
    for e in events:
        c = event_column(e)
        value = F.col(c) if c in season.columns else F.lit(None).cast("double")
        cols[c] = F.coalesce(round_half_up(value, decimals), F.lit(0.0))
    out = placed.withColumns(cols)
    return out.select(*by, "overall_place", "name", "first_name", "last_name", "n_events",
                      "series_points", *[event_column(e) for e in events])


def guard_events(event_list: Sequence, results_by_event: Sequence | None = None) -> None:
    """F8: a season needs at least one event; paired lists must be equally long."""
    if len(event_list) < 1:
        raise ValueError("a season needs at least one event")
    if results_by_event is not None and len(results_by_event) != len(event_list):
        raise ValueError("events and results must match in length")
