"""Event scoring (E1-E12) on the long ``results`` table.

One pass scores every (event, division) group at once: the group's field size is a
small aggregate joined back by broadcast, everything else is row-local arithmetic.

    max_place = max(division_place) over main-race rows of the group
    placement = (1 - (division_place - 1) / max_place) * 100
    floored   = placement if placement >= floor else floor   (null place -> floor)
    bonus     = (age - threshold) * rate if age > threshold else 0
    points    = min(floored + bonus, cap);  participation rows: flat credit
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.numbers import round_half_up
from podium.operators.joins import join_summary
from podium.operators.place import top_one
from podium.rules import CURRENT, ScoringRules

MAIN, PARTICIPATION = "main", "participation"
EVENT_KEYS = ("event", "division")
NAME_KEYS = ("first_name", "last_name")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_size(results: DataFrame, by: Sequence[str] = EVENT_KEYS,
               place: str = "division_place") -> DataFrame:
    """Max place per group over main-race rows (a max, not a count)."""
    main = results.filter(F.col("race_role") == MAIN)
    return main.groupBy(*by).agg(F.max(place).cast("long").alias("max_place"))


def placement_points(place, max_place) -> Column:
    """Linear points from place and field size."""
    return (F.lit(1) - (_c(place) - F.lit(1)) / _c(max_place)) * F.lit(100)


def floor_points(points, floor: float = CURRENT.floor) -> Column:
    """Floor; a null value also gets the floor."""
    p = _c(points)
    return F.when(p >= F.lit(floor), p).otherwise(F.lit(floor))


def age_bonus(age, threshold: int = CURRENT.age_threshold, rate: float = CURRENT.age_rate) -> Column:
    """Bonus per year above the threshold; null age gets none."""
    a = _c(age)
    return F.when(a > F.lit(threshold), (a - F.lit(threshold)) * F.lit(float(rate))).otherwise(F.lit(0.0))


def cap_points(points, cap: float = CURRENT.cap) -> Column:
    """E5: cap (a null stays null, unlike ``least``)."""
    p = _c(points)
    return F.when(p > F.lit(cap), F.lit(cap)).otherwise(p)


def with_field_size(results: DataFrame, by: Sequence[str] = EVENT_KEYS,
                    place: str = "division_place") -> DataFrame:
    """Attach ``max_place``: one row per group, computed once, broadcast when bounded."""
    return join_summary(results, field_size(results, by, place), list(by), "left")


def score_event(results: DataFrame, rules: ScoringRules = CURRENT, by: Sequence[str] = EVENT_KEYS,
                place: str = "division_place", keep_steps: bool = False) -> DataFrame:
    """Points for main and participation rows of every group in one pass.

    Participation rows get the flat credit; their place and age are not meaningful and
    are set to null. Groups without a main race simply have no field size. When the
    input already carries ``max_place`` (e.g. from ``distributed_rank(group_size=...)``,
    whose 1..n numbering has max place n), no field-size pass is run.
    """
    scored = results if "max_place" in results.columns else with_field_size(results, by, place)
    is_part = F.col("race_role") == PARTICIPATION
    placement = placement_points(place, "max_place")
    floored = floor_points(placement, rules.floor)
    bonus = age_bonus("age", rules.age_threshold, rules.age_rate)
    main_points = cap_points(floored + bonus, rules.cap)
    points = F.when(is_part, F.lit(rules.participation)).otherwise(main_points)
    out = scored.withColumns({
        "points": round_half_up(points, rules.precision),
        place: F.when(is_part, F.lit(None).cast("long")).otherwise(F.col(place).cast("long")),
        "age": F.when(is_part, F.lit(None).cast("int")).otherwise(F.col("age").cast("int")),
    })
    if keep_steps:
        out = out.withColumns({
            "placement": F.when(~is_part, placement),
            "floored": F.when(~is_part, floored),
            "bonus": F.when(~is_part, bonus),
        })
    return out


def consolidate_best(points: DataFrame, key: Sequence[str], place: str = "division_place") -> DataFrame:
    """One row per racer of a multi-day event: the row with the most points.

    On equal points a participation row wins over a main row (its flat credit equals
    the main floor), then the better place. Planned as a group limit of one, which
    keeps one row per racer in each map task before the shuffle.
    """
    is_part = (F.col("race_role") == PARTICIPATION).cast("int")
    ranked = points.withColumn("__part", is_part)
    best = top_one(ranked, key, [("points", "desc"), ("__part", "desc"), F.col(place).asc_nulls_last()])
    return best.drop("__part")


def repeat_guard(points: DataFrame, key: Sequence[str], max_days: int | DataFrame,
                 event_keys: Sequence[str] = ("event",)) -> DataFrame:
    """Racers seen more often than the event has days (likely two people, one name).

    ``max_days`` is one limit for all events, or an events table with ``event_days``
    per event (joined on ``event_keys``; the planner broadcasts it when small).
    """
    counted = points.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    if isinstance(max_days, DataFrame):
        days = max_days.select(*event_keys, F.col("event_days").cast("long").alias("__days"))
        return (counted.join(days, list(event_keys), "left")
                .filter(F.col("n_rows") > F.coalesce(F.col("__days"), F.lit(1))).drop("__days"))
    return counted.filter(F.col("n_rows") > F.lit(int(max_days)))


def dedupe_participation(main: DataFrame, part: DataFrame, event_keys: Sequence[str] = ("event",),
                         name_keys: Sequence[str] = NAME_KEYS, prefer: Sequence[str] | None = None) -> DataFrame:
    """One participation row per name, minus names that ran the main race (any division).

    ``prefer`` orders candidate rows of one name (smallest wins); default: all columns.
    One aggregate over the union of participation rows and main-race names does both
    steps: per name it keeps the preferred participation row (``min_by`` skips the
    main rows, whose ordering is null) and whether a main row exists. One shuffle,
    combined map-side, so a name shared by many rows never meets in one task whole.
    """
    key = list(event_keys) + list(name_keys)
    rest = [c for c in part.columns if c not in key]
    row = F.struct(*[F.col(c) for c in rest])
    order = F.struct(*[F.col(c) for c in (prefer or rest)])
    p = part.select(*key, row.alias("__row"), order.alias("__ord"), F.lit(0).alias("__main"))
    m = main.select(*key, F.lit(None).cast(row_type(part, rest)).alias("__row"),
                    F.lit(None).cast(p.schema["__ord"].dataType).alias("__ord"), F.lit(1).alias("__main"))
    agg = (p.unionByName(m).groupBy(*key)
           .agg(F.max("__main").alias("__has_main"), F.min_by("__row", "__ord").alias("__row")))
    return agg.filter((F.col("__has_main") == 0) & F.col("__row").isNotNull()).select(*key, "__row.*")


def dedupe_entries(entries: DataFrame, event_keys: Sequence[str] = ("event",), name_keys: Sequence[str] = NAME_KEYS,
                   prefer: Sequence[str] = ("entry_id",)) -> DataFrame:
    """E10 on one table of both roles: read and shuffled once, one group limit per name.

    Of a name's entries a main one wins; the names that it wins are dropped, the others keep
    their preferred participation row.
    """
    main = F.col("race_role") == MAIN
    one = top_one(entries, [*event_keys, *name_keys], [main.desc(), *prefer])
    return one.filter(~main)


def row_type(df: DataFrame, cols: Sequence[str]):
    """Struct type of the named columns of ``df``."""
    from pyspark.sql import types as T
    return T.StructType([df.schema[c] for c in cols])
