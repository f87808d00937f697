"""End-to-end season job on a synthetic season (FIXTURES.md shapes, hand-computed answers)."""

import os
import tempfile

import pytest

from podium.plans.season_job import run_season, write_season
from podium.schema import ALIASES, ADJUSTMENTS, EVENTS_DIM, EVENTS_DIM_MODES, MEMBERSHIP, RESULTS


def _res(spark):
    base = dict(season="s1", race="r", race_role="main", age=None, time_s=None, overall_place=None,
                division_place=None, location=None)
    rows = []

    def add(event, division, first, last, place=None, age=None, role="main"):
        d = dict(base, event=event, division=division, first_name=first, last_name=last,
                 division_place=place, age=age, race_role=role)
        rows.append(tuple(d[f.name] for f in RESULTS.fields))

    for i, (fn, ln, age) in enumerate([("A", "One", 30), ("B", "Two", 47), ("C", "Three", None),
                                       ("D", "Four", 70), ("E", "Five", 45)]):
        add("ev1", "female", fn, ln, i + 1, age)
    add("ev1", "female", "F", "Six", role="participation", age=33)
    add("ev1", "male", "M1", "X", 1, 30)
    add("ev1", "male", "M2", "Y", 2, 30)
    add("ev2", "female", "A", "One", 1, 30)       # two-day event: A races twice
    add("ev2", "female", "B", "Two", 2, 47)
    add("ev2", "female", "A", "One", 3, 30)
    add("ev2", "female", "B", "Two", role="participation")  # two days, two rows: the best counts
    return spark.createDataFrame(rows, RESULTS)


def test_season_job(spark):
    events = spark.createDataFrame([("s1", "ev1", "Event One", 1, 1), ("s1", "ev2", "Event Two", 2, 2)], EVENTS_DIM)
    members = spark.createDataFrame([("s1", "T1", "female", "A", "One"), ("s1", "T1", "female", "B", "Two"),
                                     ("s1", "T1", "male", "M1", "X")], MEMBERSHIP)
    aliases = spark.createDataFrame([("C", "Three", "Cee", "Three")], ALIASES)
    adj = spark.createDataFrame([("A", "One", -10.0)], ADJUSTMENTS)
    out = run_season(_res(spark), events, "s1", members, aliases, adj)

    pts = {(r.event, r.first_name): r.points for r in out.event_points.collect()}
    assert pts[("ev1", "A")] == 100.0 and pts[("ev1", "B")] == 82.0 and pts[("ev1", "F")] == 20.0
    assert pts[("ev2", "A")] == 100.0 and pts[("ev2", "B")] == 68.666667
    assert len([k for k in pts if k == ("ev2", "A")]) == 1 and out.event_points.count() == 10

    st = {r.name: (r.overall_place, r.series_points) for r in out.standings.collect() if r.division == "female"}
    assert st["A One"] == (1, 190.0) and st["B Two"] == (2, 150.67) and st["D Four"] == (3, 65.0)
    assert st["F Six"][0] == 5 and st["E Five"][0] == 6  # equal points: first name descending

    winners = {(r.division, r.age_group): r.name for r in out.age_group_winners.collect()}
    assert winners[("female", "41-45")] == "E Five"
    assert ("female", "46-50") not in winners  # B (47) is on the podium

    team = out.team_standings.collect()[0]
    assert (team.team_name, team.total_points, team.ev1_points, team.ev2_points) == ("T1", 450.67, 282.0, 168.67)
    assert [(r.first_name, r.actual_fn) for r in out.alias_report.collect()] == [("C", "Cee")]
    assert out.repeat_racers.count() == 0 and out.duplicate_racers.count() == 0

    root = tempfile.mkdtemp(prefix="podium-season-")
    write_season(out, root, events, "s1")
    for sub in ("event_points/season=s1/event=ev2/division=female", "individual_standings", "alias_report",
                "guard_violations", "team_standings", "team_scoring_report", "age_group_winners"):
        assert os.path.isdir(os.path.join(root, sub)), sub
    header = open(next(os.path.join(root, "team_standings", p) for p in os.listdir(f"{root}/team_standings")
                       if p.endswith(".csv"))).readline().strip()
    assert header == "Overall Place,Team Name,Total Points,Event One Points,Event Two Points"


def _rows(spark, rows):
    """(event, division, first, last, role, place, age) -> RESULTS of season s1."""
    base = dict(season="s1", race="r", time_s=None, overall_place=None, location=None)
    keys = ("event", "division", "first_name", "last_name", "race_role", "division_place", "age")
    return spark.createDataFrame([tuple((base | dict(zip(keys, r)))[f.name] for f in RESULTS.fields)
                                  for r in rows], RESULTS)


def _events(spark, *rows):
    return spark.createDataFrame([("s1", e, e.upper(), days, i, mode) for i, (e, days, mode) in enumerate(rows)],
                                 EVENTS_DIM_MODES)


MULTIDAY = [
    ("ev", "female", "Ann", "Lee", "main", 1, 30), ("ev", "female", "Flo", "Low", "main", 9, 30),
    ("ev", "female", "Flo", "Low", "participation", None, None),
    ("ev", "male", "Kim", "Ray", "main", 1, 30), ("ev", "female", "Kim", "Ray", "participation", None, None),
    ("ev", "female", "Cy", "Poe", "main", 2, 30), ("ev", "female", "Cy", "Poe", "participation", None, 20),
    ("ev", "female", "Cy", "Poe", "participation", None, 60)]


def test_multiday_event_keeps_rows_and_reports_repeats(spark):
    out = run_season(_rows(spark, MULTIDAY), _events(spark, ("ev", 2, None)), "s1", on_violation="report")
    assert [(r.first_name, r.n_rows) for r in out.repeat_racers.collect()] == [("Cy", 3)]
    pts = {(r.division, r.first_name): (r.points, r.race_role, r.division_place) for r in out.event_points.collect()}
    assert pts[("female", "Flo")] == (20.0, "participation", None)  # equal points: the credit wins
    assert pts[("female", "Kim")] == (20.0, "participation", None)  # another division's name does not count
    assert pts[("male", "Kim")][1] == "main"
    with pytest.raises(ValueError, match="repeat_racer"):
        run_season(_rows(spark, MULTIDAY), _events(spark, ("ev", 2, None)), "s1")


def test_one_day_event_reports_duplicates_unless_deduped(spark):
    rows = [("ev", "male", "Bo", "Fox", "participation", None, 20), ("ev", "male", "Bo", "Fox", "participation", None, 60),
            ("ev", "male", "Al", "Ash", "main", 1, 30), ("ev", "male", "Al", "Ash", "participation", None, 30)]
    raw = run_season(_rows(spark, rows), _events(spark, ("ev", 1, "consolidate")), "s1", on_violation="report")
    assert sorted(r.first_name for r in raw.duplicate_racers.collect()) == ["Al", "Bo"]
    once = run_season(_rows(spark, rows), _events(spark, ("ev", 1, "dedupe")), "s1")
    assert sorted((r.first_name, r.race_role) for r in once.event_points.collect()) == [
        ("Al", "main"), ("Bo", "participation")]
    none = run_season(_rows(spark, rows), _events(spark, ("ev", 1, "none")), "s1")
    assert [r.first_name for r in none.event_points.collect()] == ["Al"]


def test_guards_on_members_divisions_and_events(spark):
    rows = [("ev", "male", "Al", "Ash", "main", 1, 30), ("ev", "??", "Bo", "Fox", "main", 1, 30)]
    members = spark.createDataFrame([("s1", "T1", "male", "Al", "Ash"), ("s1", "T2", "male", "Al", "Ash"),
                                     ("s1", "T2", None, "Cy", "Poe"), ("s1", "T2", "male", "Ed", "")], MEMBERSHIP)
    out = run_season(_rows(spark, rows), _events(spark, ("ev", 1, None)), "s1", members, on_violation="report")
    assert sorted((r.guard, r.key) for r in out.violations.collect()) == [
        ("membership_division", "T2 / Cy"), ("membership_name", "T2 / Ed"), ("membership_racer", "Al Ash"),
        ("unknown_division", "ev / ??")]
    with pytest.raises(ValueError, match="no events"):
        run_season(_rows(spark, rows), _events(spark, ("ev", 1, None)), "s9")


def test_cli_uses_the_session_it_is_given(spark):
    import inspect

    from podium import cli
    assert "master(" not in inspect.getsource(cli) and "build_session" not in inspect.getsource(cli)


def test_cli_reads_csv_by_header_name(spark):
    """The command line reads headed CSV in any column order and writes the reports."""
    from podium.cli import main
    d = tempfile.mkdtemp(prefix="podium-cli-")
    res = _res(spark).select("first_name", "last_name", "season", "event", "division", "race_role",
                             "division_place", "age")  # other order, optional columns absent
    res.coalesce(1).write.option("header", True).csv(f"{d}/results.csv")
    with open(f"{d}/events.csv", "w") as f:
        f.write("SEASON,Event,human_name,event_days,seq\ns1,ev1,Event One,1,1\ns1,ev2,Event Two,2,2\n")
    with open(f"{d}/sheet.csv", "w") as f:
        f.write("Team Name:,Team captain/representative name:,Team captain gender,2nd team member name,"
                "2nd team member gender,3rd team member name,3rd team member gender\n"
                "T1,A One,F,B Two,female,M1 X,Male\n")
    info = main(["--results", f"{d}/results.csv", "--events", f"{d}/events.csv", "--season", "s1",
                 "--team-sheet", f"{d}/sheet.csv", "--out", f"{d}/out"], spark=spark)
    assert info["events"] == ["ev1", "ev2"] and info["racers"] == 8
    assert os.path.isdir(f"{d}/out/team_standings") and os.path.isdir(f"{d}/out/event_points/season=s1")
    teams = spark.read.option("header", True).csv(f"{d}/out/team_standings").collect()
    assert [(r["Team Name"], r["Total Points"]) for r in teams] == [("T1", "450.67")]


def test_team_guard_sees_a_name_used_twice(spark):
    """On the raw forms, or by slots that are filled twice; a racer of two teams scores for none."""
    events = spark.createDataFrame([("s1", "ev1", "Event One", 1, 1), ("s1", "ev2", "Event Two", 2, 2)], EVENTS_DIM)
    rows = [("s1", "T1", 1, "female", "A", "One"), ("s1", "T1", 1, "female", "B", "Two"), ("s1", "T2", 1, "male", "M1", "X"),
            ("s1", "T2", 2, "female", "A", "One")]
    members = spark.createDataFrame(rows, "season string, team_name string, slot int, division string, first_name string, last_name string")
    with pytest.raises(ValueError, match="membership_team"):
        run_season(_res(spark), events, "s1", members)
    forms = spark.createDataFrame([("T1",), ("T2",), ("T2",)], "team_name string")
    out = run_season(_res(spark), events, "s1", members.drop("slot"), registration=forms, on_violation="report")
    found = {(r.guard, r.key): r.n_rows for r in out.violations.collect()}
    assert found[("membership_team", "T2")] == 2 and found[("membership_racer", "A One")] == 2
    assert ("membership_team", "T1") not in found
    assert {r.team_name: r.total_points for r in out.team_standings.collect()} == {"T1": 150.67, "T2": 100.0}
