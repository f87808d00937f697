"""Season standings, teams and age groups on small synthetic tables."""

import pytest
from pyspark.sql import functions as F

from podium.functions.numbers import step_bonus
from podium.operators.agegroup import age_bands, age_group_winners, band_join, modal_age
from podium.operators.season import apply_adjustments, season_points, standings_wide
from podium.operators.team import (guard_membership, team_event_points, team_event_rows, team_ranked,
                                   team_report, unpivot_membership)


def _points(spark, rows):
    return spark.createDataFrame(rows, "event string, division string, first_name string, "
                                       "last_name string, age int, points double")


def test_best_six_incentive_adjustment(spark):
    # FIXTURES worked example: 100, 82, 60, 65, 20, 20, 90 -> best six 417, +35, -10
    pts = [100, 82, 60, 65, 20, 20, 90]
    rows = [(f"e{i}", "female", "Ann", "Lee", 40, float(p)) for i, p in enumerate(pts)]
    s = season_points(_points(spark, rows), events=[f"e{i}" for i in range(7)])
    r = s.collect()[0]
    assert (r.n_events, r.best_points, r.incentive, r.series_points) == (7, 417.0, 35.0, 452.0)
    adj = spark.createDataFrame([("Ann", "Lee", -10.0), ("No", "Body", 5.0)],
                                "first_name string, last_name string, bias_adjustment double")
    assert apply_adjustments(s, adj).collect()[0].series_points == 442.0


@pytest.mark.parametrize("n,expected", [(0, 0), (2, 0), (3, 15), (5, 15), (6, 35), (8, 35), (9, 60), (12, 60)])
def test_step_bonus(spark, n, expected):
    from podium.rules import INCENTIVE_STEPS
    v = spark.range(1).select(step_bonus(F.lit(n), INCENTIVE_STEPS).alias("b")).collect()[0].b
    assert v == expected


def test_standings_place_ties_and_zero_columns(spark):
    rows = [("e1", "male", "Bo", "A", None, 50.0), ("e1", "male", "Al", "B", None, 50.0),
            ("e2", "male", "Cy", "C", None, 90.0)]
    s = season_points(_points(spark, rows), events=["e1", "e2", "e3"])
    w = standings_wide(s, ["e1", "e2", "e3"]).orderBy("overall_place").collect()
    assert [r.name for r in w] == ["Cy C", "Bo A", "Al B"]  # ties: first name descending
    assert [r.overall_place for r in w] == [1, 2, 3]
    assert all(r.e3_points == 0.0 for r in w)


def test_rounding_half_up(spark):
    from podium.functions.numbers import round_half_up
    v = spark.range(1).select(round_half_up(F.lit(90.625), 2).alias("a"),
                              round_half_up(F.lit(1.005), 2).alias("b")).collect()[0]
    assert v.a == 90.63 and v.b == 1.0


def _registration(spark):
    cols = ["team_name"] + [c for i in range(1, 4) for c in (f"n{i}", f"g{i}")]
    rows = [("Fast", "Ann Lee", "F", "Bob Ray Jr", "m", "na", "F"),
            ("Slow", "Cat Poe", "female", "", "M", None, None)]
    return spark.createDataFrame(rows, cols)


def test_unpivot_membership_and_guard(spark):
    from podium.functions.division import division_from_prefix
    reg = _registration(spark)
    m = unpivot_membership(reg, "team_name", [("n1", "g1"), ("n2", "g2"), ("n3", "g3")],
                           division_of=division_from_prefix)
    got = sorted((r.team_name, r.division, r.first_name, r.last_name) for r in m.collect())
    assert got == [("Fast", "female", "Ann", "Lee"), ("Fast", "male", "Bob", "Ray Jr"),
                   ("Slow", "female", "Cat", "Poe")]
    dup = reg.unionByName(reg.limit(1))
    g = guard_membership(dup, m.unionByName(m.filter(F.col("first_name") == "Ann")))
    assert sorted((r.kind, r.key, r.n_rows) for r in g.collect()) == [("racer", "Ann Lee", 2), ("team", "Fast", 2)]


def test_team_top3_and_sum(spark):
    members = spark.createDataFrame(
        [("T", "female", f"F{i}", "X") for i in range(5)] + [("T", "male", "M0", "X")],
        "team_name string, division string, first_name string, last_name string")
    rows = [("e1", "female", f"F{i}", "X", None, float(p)) for i, p in enumerate([90, 80, 80, 70, 60])]
    rows += [("e1", "male", "M0", "X", None, 50.0)]
    ranked = team_ranked(team_event_rows(_points(spark, rows), members))
    per = team_event_points(ranked).collect()
    assert per[0].team_points == 90 + 80 + 80 + 50
    rep = {(r.first_name, r.team_rank, r.is_scoring) for r in team_report(ranked).collect()}
    assert ("F3", 4, "No") in rep and ("M0", 1, "Yes") in rep


def test_age_groups(spark):
    ages = spark.createDataFrame([("f", "A", 30), ("f", "A", 31), ("f", "A", 31), ("f", "B", 40), ("f", "B", 41),
                                  ("f", "C", 71), ("f", "D", 124)],
                                 "division string, name string, age long")
    modal = modal_age(ages)
    got = {r.name: r.age for r in modal.collect()}
    assert got == {"A": 31, "B": 40, "C": 71, "D": 124}  # tie -> lowest
    banded = {r.name: r.age_group for r in band_join(modal, age_bands(spark)).collect()}
    assert banded == {"A": "31-35", "B": "36-40", "C": "71-123"}  # 124: no band
    st = spark.createDataFrame([("f", "A", 4), ("f", "B", 2), ("f", "C", 9), ("f", "E", 5)],
                               "division string, name string, overall_place long")
    w = {(r.age_group, r.name) for r in age_group_winners(st, modal, age_bands(spark)).collect()}
    assert w == {("31-35", "A"), ("71-123", "C")}  # B is on the podium


def test_empty_division_standings_keep_schema(spark):
    empty = _points(spark, [])
    w = standings_wide(season_points(empty, events=["e1"]), ["e1"])
    assert w.count() == 0
    assert "e1_points" in w.columns and "overall_place" in w.columns


def test_guard_one_word_and_unreadable_division(spark):
    from podium.functions.division import division_from_prefix
    reg = spark.createDataFrame([("T", "Solo", "m", "Ann Lee", "x")], "team_name string, n1 string, g1 string, "
                                                                      "n2 string, g2 string")
    m = unpivot_membership(reg, "team_name", [("n1", "g1"), ("n2", "g2")], division_of=division_from_prefix)
    g = sorted((r.kind, r.key) for r in guard_membership(reg, m).collect())
    assert g == [("division", "T / Ann"), ("name", "T / Solo")]


def test_repeat_guard_with_event_days(spark):
    from podium.operators.event import repeat_guard
    rows = [("e1", "f", "A", "x", None, 20.0)] * 2 + [("e2", "f", "A", "x", None, 20.0)] * 2
    days = spark.createDataFrame([("e1", 2), ("e2", 1)], "event string, event_days int")
    g = repeat_guard(_points(spark, rows), ["event", "division", "first_name", "last_name"], days)
    assert [(r.event, r.n_rows) for r in g.collect()] == [("e2", 2)]


def test_alias_report_exact_and_case_insensitive(spark):
    from podium.operators.quality import alias_report
    pts = _points(spark, [("e1", "f", "ann", "lee", 30, 80.0), ("e1", "f", "Bo", "Ray", 30, 70.0)])
    aliases = spark.createDataFrame([("Ann", "Lee", "Anne", "Lee"), ("Bo", "Ray", "Robert", "Ray")],
                                    "alias_fn string, alias_ln string, actual_fn string, actual_ln string")
    exact = sorted(r.actual_fn for r in alias_report(pts, aliases).collect())
    loose = sorted(r.actual_fn for r in alias_report(pts, aliases, case_insensitive=True).collect())
    assert exact == ["Robert"] and loose == ["Anne", "Robert"]


def test_registration_sheet(spark, tmp_path):
    """T1/T2 on the sheet layout: na cells, mixed-case gender, three-word and one-word names."""
    from podium.operators.team import form_slots, unpivot_registration
    from podium.sources.files import read_csv_by_name
    from pyspark.sql import types as T
    slots = form_slots()
    assert slots[1] == ("2nd team member name", "2nd team member gender") and len(slots) == 10
    assert slots[-1] == ("10th team member name", "10th team member gender")
    header = ["Team Name:"] + [c for pair in slots for c in pair]
    rows = [["Fast", "Ann Lee", "Female", "Mary Ann Poe", "f", "na", "M"] + [""] * 14,
            ["Slow", "Solo", "MALE", "Bo Ray", "x"] + [""] * 16]
    text = ",".join(f'"{h}"' for h in header) + "\n" + "\n".join(",".join(r) for r in rows) + "\n"
    (tmp_path / "teams.csv").write_text(text)
    schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
    sheet = read_csv_by_name(spark, str(tmp_path / "teams.csv"), schema)
    m = unpivot_registration(sheet)
    got = sorted((r.team_name, r.slot, r.division, r.first_name, r.last_name) for r in m.collect())
    assert got == [("Fast", 1, "female", "Ann", "Lee"), ("Fast", 2, "female", "Mary", "Ann Poe"),
                   ("Slow", 1, "male", "Solo", ""), ("Slow", 2, None, "Bo", "Ray")]
    g = sorted((r.kind, r.key) for r in guard_membership(sheet.withColumnRenamed("Team Name:", "team_name"), m)
               .collect())
    assert g == [("division", "Slow / Bo"), ("name", "Slow / Solo")]
