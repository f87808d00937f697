"""Team scoring.

Teams register on a fixed-width form (a name and a division cell per member slot);
the form is unpivoted to a long membership table. A team's rows per event and
division are bounded by the form width, so the team-internal rank is a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.numbers import exact_sum, round_half_up, to_units
from podium.functions.text import split_first_rest
from podium.operators.joins import spread_join
from podium.operators.place import distributed_rank, window_rank
from podium.operators.quality import find_duplicates
from podium.operators.season import event_column
from podium.rules import (CAPTAIN_HEADERS, CURRENT, FORM_SLOTS, MEMBER_HEADER, NOT_A_NAME, TEAM_NAME_HEADER,
                          ScoringRules)

MEMBER_KEYS = ("division", "first_name", "last_name")


def ordinal(n: int) -> str:
    """1st, 2nd, 3rd, 4th, ... (English ordinal suffix)."""
    suffix = "th" if 10 <= n % 100 <= 20 else {1: "st", 2: "nd", 3: "rd"}.get(n % 10, "th")
    return f"{n}{suffix}"


def form_slots(n: int = FORM_SLOTS) -> list[tuple[str, str]]:
    """(name column, gender column) pairs of the registration sheet: captain, then 2nd..nth."""
    return [CAPTAIN_HEADERS] + [(MEMBER_HEADER.format(ordinal=ordinal(i), field="name"),
                                 MEMBER_HEADER.format(ordinal=ordinal(i), field="gender"))
                                for i in range(2, n + 1)]


def unpivot_registration(sheet: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """T1 on the registration sheet layout (team name header, captain + member columns).

    All member columns of the sheet are read, however many there are; a name column
    without its gender column (or the other way round) raises. Genders read by prefix.
    """
    from podium.functions.division import division_from_prefix
    pairs = form_slots(max(FORM_SLOTS, len(sheet.columns)))
    half = [n if n in sheet.columns else g for n, g in pairs if (n in sheet.columns) != (g in sheet.columns)]
    if half:
        raise ValueError(f"member columns without their counterpart: {half}")
    slots = [(n, g) for n, g in pairs if n in sheet.columns]
    return unpivot_membership(sheet, TEAM_NAME_HEADER, slots, division_of=division_from_prefix, keep=keep)


def unpivot_membership(wide: DataFrame, team_col: str, slots: Sequence[tuple[str, str]],
                       division_of=None, keep: Sequence[str] = ()) -> DataFrame:
    """Wide registration rows -> one row per member.

    ``slots`` lists (name column, division column) pairs. Empty names and the
    not-a-name markers are skipped; ``division_of`` maps the division cell (default:
    trimmed text). Names split as first token / rest.
    """
    pairs = F.array(*[
        F.struct(F.lit(i + 1).alias("slot"), F.col(n).cast("string").alias("raw_name"),
                 F.col(g).cast("string").alias("raw_division"))
        for i, (n, g) in enumerate(slots)])
    long = wide.select(*keep, F.col(team_col).alias("team_name"), F.explode(pairs).alias("m"))
    name = F.trim(F.col("m.raw_name"))
    keep_row = (name.isNotNull() & (name != "") & F.col("m.raw_division").isNotNull()
                & ~F.lower(name).isin(*NOT_A_NAME))
    long = long.filter(keep_row)
    first, last = split_first_rest(name)
    division = (division_of(F.col("m.raw_division")) if division_of
                else F.trim(F.col("m.raw_division")))
    return long.select(*keep, "team_name", F.col("m.slot").alias("slot"),
                       division.alias("division"), first.alias("first_name"), last.alias("last_name"))


def guard_membership(wide: DataFrame, membership: DataFrame, team_col: str = "team_name") -> DataFrame:
    """T1/T2 checks as rows (kind, key, n_rows).

    Kinds: ``team`` duplicate team name; ``racer`` racer in more than one team;
    ``division`` member whose division cell could not be read; ``name`` one-word name.
    """
    teams = (find_duplicates(wide.select(F.col(team_col).alias("team_name")), ["team_name"])
             .select(F.lit("team").alias("kind"), F.col("team_name").alias("key"), "n_rows"))
    racers = (find_duplicates(membership, ["first_name", "last_name"])
              .select(F.lit("racer").alias("kind"),
                      F.concat_ws(" ", "first_name", "last_name").alias("key"), "n_rows"))
    member = F.concat_ws(" / ", "team_name", "first_name")
    bad_division = (membership.filter(F.col("division").isNull())
                    .groupBy(member.alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
                    .select(F.lit("division").alias("kind"), "key", "n_rows"))
    one_word = (membership.filter(F.col("last_name") == "")
                .groupBy(member.alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit("name").alias("kind"), "key", "n_rows"))
    return teams.unionByName(racers).unionByName(bad_division).unionByName(one_word)


def team_event_rows(points: DataFrame, membership: DataFrame,
                    keys: Sequence[str] = MEMBER_KEYS, spread: bool = False) -> DataFrame:
    """members' scored rows (inner join on division and name; null points dropped).

    ``spread`` looks for names that hold a large share of the rows first and deals those over all tasks.
    """
    members = membership.select("team_name", *keys)
    scored = points.filter(F.col("points").isNotNull())
    return spread_join(scored, members, keys) if spread else scored.join(members, list(keys), "inner")


def team_ranked(rows: DataFrame, rules: ScoringRules = CURRENT,
                group: Sequence[str] = ("team_name", "event", "division")) -> DataFrame:
    """R6 + T4 flag: rank inside team, event and division: points desc, last, first asc.

    Rows meet per (team, event, division), so a large team is spread over its events and
    divisions; the guard on team names (``guard_membership``) keeps a group within one form.
    """
    ranked = window_rank(rows.withColumn("__units", to_units("points", rules.precision)), group, [("__units", "desc"), "last_name", "first_name"], "team_rank")
    return ranked.withColumn("is_scoring", F.col("team_rank") <= F.lit(rules.team_k)).drop("__units")


def team_top_k(ranked: DataFrame) -> DataFrame:
    """T4: the scoring rows (rank within the top k)."""
    return ranked.filter(F.col("is_scoring"))


def team_event_points(ranked: DataFrame, rules: ScoringRules = CURRENT) -> DataFrame:
    """T5: team points per event: exact sum of the scorers over all divisions."""
    return (team_top_k(ranked).groupBy("team_name", "event")
            .agg(exact_sum("points", rules.precision).alias("team_points")))


def team_standings(per_event: DataFrame, events: Sequence, decimals: int = 2) -> DataFrame:
    """One row per team with a scorer: events as columns (0 if none), total, place.

    Place: total desc, then team name (a total order for equal totals).
    """
    aggs = [F.sum(to_units("team_points")).alias("__total")]
    for e in events:
        aggs.append(F.coalesce(F.max(F.when(F.col("event") == F.lit(e), F.col("team_points"))),
                               F.lit(0.0)).alias(event_column(e)))
    agg = per_event.groupBy("team_name").agg(*aggs)
    agg = agg.withColumn("total_points", F.col("__total") / F.lit(1e6)).drop("__total")
    placed = distributed_rank(agg, [], [("total_points", "desc"), "team_name"], "overall_place")
    cols = {"total_points": round_half_up("total_points", decimals)}
    for e in events:
        cols[event_column(e)] = round_half_up(event_column(e), decimals)
    return placed.withColumns(cols).select("overall_place", "team_name", "total_points",
                                          *[event_column(e) for e in events])


def team_report(ranked: DataFrame, decimals: int = 2) -> DataFrame:
    """Every member row with rounded points, team rank and a Yes/No scoring flag."""
    return ranked.select(
        "team_name", "event", "division", "first_name", "last_name", "team_rank",
        round_half_up("points", decimals).alias("event_points"),
        F.when(F.col("is_scoring"), F.lit("Yes")).otherwise(F.lit("No")).alias("is_scoring"))
