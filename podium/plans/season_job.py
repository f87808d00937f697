"""One season, end to end: results -> event points -> standings, teams, age groups, quality.

Input is the long ``results`` table (schema ``podium.schema.RESULTS``) of one season,
the events table (``EVENTS_DIM``: event, human name, days, order) and optional
membership, aliases and adjustments. Event points are scored for every event and
division in one pass and checkpointed once; the individual, team, age-group and
alias branches all read that one copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.operators.agegroup import age_bands, age_group_winners, collect_ages, modal_age
from podium.operators.clean import KNOWN_DIVISIONS, quarantine_unknown_division
from podium.operators.event import (MAIN, PARTICIPATION, consolidate_best, dedupe_participation,
                                    repeat_guard, score_event)
from podium.operators.joins import null_safe_join
from podium.operators.quality import alias_report, find_duplicates, raise_if_any
from podium.operators.season import apply_adjustments, event_column, season_points, standings_wide
from podium.operators.team import (guard_membership, team_event_points, team_event_rows, team_ranked, team_report,
                                   team_standings)
from podium.rules import CURRENT, TEAM_NAME_HEADER, ScoringRules
from podium.session import cut_lineage
from podium.sources.files import write_event_points, write_report

EVENT_KEYS = ["event", "division"]
RACER = ["event", "division", "first_name", "last_name"]
POINT_COLS = ["season", "event", "division", "first_name", "last_name", "age", "division_place",
              "race_role", "points"]


@dataclass
class SeasonOutputs:
    event_points: DataFrame
    standings: DataFrame
    team_standings: DataFrame | None
    team_report: DataFrame | None
    age_group_winners: DataFrame
    alias_report: DataFrame | None
    repeat_racers: DataFrame
    duplicate_racers: DataFrame
    events: list
    violations: DataFrame


def season_events(events_dim: DataFrame, season: str) -> list[str]:
    """Event keys of the season in calendar order (a dimension: a handful of rows)."""
    rows = (events_dim.filter(F.col("season") == season).select("event", "seq")
            .distinct().orderBy("seq", "event").collect())
    return [r.event for r in rows]


def score_season_events(results: DataFrame, events_dim: DataFrame, season: str,
                        rules: ScoringRules = CURRENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """E1-E12 for every event of the season: (event points, repeat offenders, duplicates).

    The events table says per event how participation rows count (``participation_mode``):
    ``consolidate`` (default) keeps them all, ``dedupe`` keeps one per name and none for names
    that ran the main race, ``none`` leaves them out. All guards look at the scored rows
    before any row is merged: a racer may occur as often as a multi-day event has days, and
    once in a one-day event. Multi-day events then keep each racer's best row.
    """
    res = results.filter(F.col("season") == season)
    mode = F.col("participation_mode") if "participation_mode" in events_dim.columns else F.lit(None)
    days = (events_dim.filter(F.col("season") == season)
            .select("event", F.coalesce(F.col("event_days").cast("int"), F.lit(1)).alias("event_days"),
                    F.coalesce(mode.cast("string"), F.lit("consolidate")).alias("participation_mode")))
    known = cut_lineage(res.join(days, "event", "left").withColumns({
        "event_days": F.coalesce("event_days", F.lit(1)),
        "participation_mode": F.coalesce("participation_mode", F.lit("consolidate"))}), "results")
    is_part = F.col("race_role") == PARTICIPATION
    asked = F.col("participation_mode") == "dedupe"
    plain = known.filter((F.col("race_role") == MAIN) | (is_part & (F.col("participation_mode") == "consolidate")))
    once = dedupe_participation(known.filter((F.col("race_role") == MAIN) & asked),
                                known.filter(is_part & asked), event_keys=["season", "event"])
    scored = cut_lineage(score_event(plain.unionByName(once.select(*plain.columns)), rules, EVENT_KEYS), "scored")
    multi, single = scored.filter(F.col("event_days") > 1), scored.filter(F.col("event_days") <= 1)
    repeats = repeat_guard(multi, RACER, days)
    duplicates = find_duplicates(single, RACER)
    best = consolidate_best(multi, RACER)
    points = single.select(*POINT_COLS).unionByName(best.select(*POINT_COLS))
    return points, repeats, duplicates


def team_names(membership: DataFrame, registration: DataFrame | None) -> DataFrame:
    """(team_name): a row per registration form, so that a name used twice can be seen.

    Without the forms themselves a long membership table still shows it by its ``slot`` column:
    two forms of one name fill a slot twice.
    """
    if registration is not None:
        name = "team_name" if "team_name" in registration.columns else TEAM_NAME_HEADER
        return registration.select(F.col(f"`{name}`").alias("team_name"))
    if "slot" not in membership.columns:
        return membership.select("team_name").distinct()
    forms = membership.groupBy("team_name", "slot").agg(F.count(F.lit(1)).cast("int").alias("n"))
    forms = forms.groupBy("team_name").agg(F.max("n").alias("n"))
    return forms.select("team_name", F.explode(F.sequence(F.lit(1), "n"))).select("team_name")


def season_violations(results: DataFrame, season: str, repeats: DataFrame, duplicates: DataFrame,
                      membership: DataFrame | None, divisions: Sequence[str] | None,
                      registration: DataFrame | None = None) -> DataFrame:
    """All guard findings of a season as rows (guard, key, n_rows)."""
    def rows(df: DataFrame, guard: str, cols: list[str], n: str = "n_rows") -> DataFrame:
        key = F.concat_ws(" / ", *[F.col(c).cast("string") for c in cols])
        return df.select(F.lit(guard).alias("guard"), key.alias("key"), F.col(n).cast("long").alias("n_rows"))

    found = rows(repeats, "repeat_racer", RACER).unionByName(rows(duplicates, "duplicate_racer", RACER))
    if divisions is not None:
        _, unknown = quarantine_unknown_division(results.filter(F.col("season") == season), known=divisions)
        unknown = unknown.groupBy("event", "division").agg(F.count(F.lit(1)).alias("n_rows"))
        found = found.unionByName(rows(unknown, "unknown_division", ["event", "division"]))
    if membership is not None:
        members = guard_membership(team_names(membership, registration), membership)
        found = found.unionByName(members.select(F.concat(F.lit("membership_"), "kind").alias("guard"), "key", "n_rows"))
    return found


def run_season(results: DataFrame, events_dim: DataFrame, season: str,
               membership: DataFrame | None = None, aliases: DataFrame | None = None,
               adjustments: DataFrame | None = None, rules: ScoringRules = CURRENT,
               on_violation: str = "raise",
               divisions: Sequence[str] | None = KNOWN_DIVISIONS,
               registration: DataFrame | None = None,
               team_divisions: Sequence[str] | None = ("male", "female")) -> SeasonOutputs:
    """Score a season. A guard that finds an offender raises; with ``on_violation="report"``
    the job goes on, the offenders are an output table, and racers of more than one team score
    for none. ``divisions`` lists the divisions a row may have (None: any), ``team_divisions`` those that
    score for teams. ``registration`` has the raw team forms (a row per form), which the guard on team names needs
    unless ``membership`` has slots."""
    if on_violation not in ("raise", "report"):
        raise ValueError(f"on_violation must be 'raise' or 'report', not {on_violation!r}")
    spark = results.sparkSession
    events = season_events(events_dim, season)
    if not events:
        raise ValueError(f"season {season!r} has no events")
    if membership is not None and "season" in membership.columns:
        membership = membership.filter(F.col("season") == season)
    points, repeats, duplicates = score_season_events(results, events_dim, season, rules)
    violations = cut_lineage(season_violations(results, season, repeats, duplicates, membership, divisions,
                                               registration), "violations")
    if on_violation == "raise":
        raise_if_any(violations, f"season {season!r} breaks its guards")
    points = cut_lineage(points, "event-points")  # scored once; every branch below reads this copy

    season_df = season_points(points, rules, events=events)
    if adjustments is not None:
        season_df = apply_adjustments(season_df, adjustments)
    standings = standings_wide(season_df, events)

    t_standings = t_report = None
    if membership is not None:
        if on_violation == "report":
            twice = find_duplicates(membership, ["first_name", "last_name"])
            membership = null_safe_join(membership, twice, ["first_name", "last_name"], "left_anti")
        team_points = points if team_divisions is None else points.filter(F.col("division").isin(*team_divisions))
        ranked = team_ranked(team_event_rows(team_points, membership, spread=True), rules)
        t_standings = team_standings(team_event_points(ranked, rules), events)
        t_report = team_report(ranked)

    winners = age_group_winners(standings, modal_age(collect_ages(points)), age_bands(spark))
    aliases_out = alias_report(points, aliases, spread=True) if aliases is not None else None
    return SeasonOutputs(points, standings, t_standings, t_report, winners, aliases_out,
                         repeats, duplicates, events, violations)


def write_season(out: SeasonOutputs, root: str, events_dim: DataFrame | None = None,
                 season: str | None = None) -> None:
    """Event-point files per (season, event, division) and the season reports.

    ``season`` picks the rows of ``events_dim`` whose display names are used. The alias
    report and the guards' findings are written with the other reports.
    """
    write_event_points(out.event_points, f"{root}/event_points")
    names, shown = {}, {}
    if events_dim is not None:
        own = events_dim if season is None else events_dim.filter(F.col("season") == season)
        own = own.filter(F.col("event").isin(*out.events)) if out.events else own
        shown = {r.event: r.human_name for r in own.select("event", "human_name").distinct().collect()}
        names = {event_column(e): f"{n} Points" for e, n in shown.items()}
    individual = {"overall_place": "Overall Place", "name": "Name", "n_events": "Number of Events",
                  "series_points": "Series Points", **names}
    standings = out.standings.drop("first_name", "last_name")
    write_report(standings, f"{root}/individual_standings", individual,
                 order=["division", "overall_place"])
    if out.team_standings is not None:
        write_report(out.team_standings, f"{root}/team_standings",
                     {"overall_place": "Overall Place", "team_name": "Team Name", "total_points": "Total Points",
                      **names}, order=["overall_place"])
        named = out.team_report
        if shown:
            display = F.create_map(*[F.lit(x) for pair in shown.items() for x in pair])
            named = named.withColumn("event", F.coalesce(display[F.col("event")], F.col("event")))
        write_report(named.withColumnRenamed("division", "gender"), f"{root}/team_scoring_report", None,
                     order=["team_name", "event", "gender", "team_rank"])
    write_report(out.age_group_winners.withColumnRenamed("age_group", "Age Group")
                 .withColumnRenamed("name", "Name").withColumnRenamed("overall_place", "Overall Place"),
                 f"{root}/age_group_winners", None, order=["division", "Age Group"])
    if out.alias_report is not None:
        write_report(out.alias_report, f"{root}/alias_report", None, order=["event", "division", "last_name"])
    write_report(out.violations, f"{root}/guard_violations", None, order=["guard", "key"])
