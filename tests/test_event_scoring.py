"""Event scoring on the synthetic worked example (FIXTURES.md section 4)."""


from podium.operators.event import consolidate_best, dedupe_participation, repeat_guard, score_event
from podium.schema import RESULTS


def _results(spark, rows):
    full = []
    for r in rows:
        d = dict(season="s1", event="e1", race="r", race_role="main", division="female",
                 first_name=None, last_name=None, age=None, time_s=None, overall_place=None,
                 division_place=None, location=None)
        d.update(r)
        full.append(tuple(d[f.name] for f in RESULTS.fields))
    return spark.createDataFrame(full, RESULTS)


def test_worked_example(spark):
    rows = [dict(first_name="A", last_name="One", division_place=1, age=30),
            dict(first_name="B", last_name="Two", division_place=2, age=47),
            dict(first_name="C", last_name="Three", division_place=3, age=None),
            dict(first_name="D", last_name="Four", division_place=4, age=70),
            dict(first_name="E", last_name="Five", division_place=5, age=45),
            dict(first_name="F", last_name="Six", race_role="participation", division_place=None, age=33)]
    out = score_event(_results(spark, rows), keep_steps=True)
    got = {r.first_name: (r.points, r.bonus, r.division_place, r.age)
           for r in out.collect()}
    assert got["A"][0] == 100.0
    assert got["B"][:2] == (82.0, 2.0)
    assert got["C"][:2] == (60.0, 0.0)
    assert got["D"][:2] == (65.0, 25.0)
    assert got["E"][:2] == (20.0, 0.0)
    # participation: flat credit, place and age not meaningful
    assert got["F"] == (20.0, None, None, None)


def test_cap_floor_and_max_place_not_count(spark):
    # places 1 and 10 only: max place 10 (not the row count 2); old age capped at 100
    rows = [dict(first_name="A", last_name="x", division_place=1, age=90),
            dict(first_name="B", last_name="y", division_place=10, age=50)]
    got = {r.first_name: r.points for r in score_event(_results(spark, rows)).collect()}
    assert got["A"] == 100.0
    assert got["B"] == 25.0  # placement 10 -> floored 20, +5 bonus


def test_groups_scored_independently(spark):
    rows = [dict(first_name="A", last_name="x", division_place=1, division="male"),
            dict(first_name="B", last_name="y", division_place=2, division="male"),
            dict(first_name="C", last_name="z", division_place=1, division="female")]
    got = {r.first_name: r.points for r in score_event(_results(spark, rows)).collect()}
    assert got == {"A": 100.0, "B": 50.0, "C": 100.0}


def test_consolidate_prefers_participation_on_tie(spark):
    rows = [dict(first_name="A", last_name="x", division_place=1),
            dict(first_name="B", last_name="y", division_place=6),
            dict(first_name="B", last_name="y", race_role="participation"),
            dict(first_name="Z", last_name="z", division_place=5)]
    scored = score_event(_results(spark, rows))
    best = consolidate_best(scored, ["event", "division", "first_name", "last_name"])
    b = [r for r in best.collect() if r.first_name == "B"]
    assert len(b) == 1 and b[0].race_role == "participation" and b[0].points == 20.0
    guard = repeat_guard(scored, ["event", "division", "first_name", "last_name"], max_days=1)
    assert [(r.first_name, r.n_rows) for r in guard.collect()] == [("B", 2)]


def test_dedupe_participation_any_division(spark):
    main = _results(spark, [dict(first_name="A", last_name="x", division_place=1, division="male")])
    part = _results(spark, [dict(first_name="A", last_name="x", race_role="participation", division="female"),
                            dict(first_name="B", last_name="y", race_role="participation"),
                            dict(first_name="B", last_name="y", race_role="participation")])
    kept = dedupe_participation(main, part, event_keys=["event"])
    assert sorted((r.first_name, r.last_name) for r in kept.collect()) == [("B", "y")]


def test_several_races_in_one_csv(spark, tmp_path):
    """S1 + P4 + P1 + N2 + N8: two main races share one place scale (two winners with place 1)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from podium.functions.division import division_map
    from podium.functions.text import split_first_last
    from podium.operators.clean import drop_null, tag_race_role
    from podium.sources.files import read_csv_by_name
    (tmp_path / "r.csv").write_text(
        "event,name,gender,age,place\n"
        "CLASSIC 18K,Ann B Lee,F,40,1\nCLASSIC 18K,Di Day,F,30,2\n"
        "SKATE 18K,Cy Poe,F,50,1\nSKATE 18K,Eve Ash,F,20,3\n"
        "TOUR 6K,Fay Oak,F,33,\nTOUR 6K,Gus Elm,X,60,\n")
    schema = T.StructType([T.StructField("event", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("gender", T.StringType()), T.StructField("age", T.IntegerType()),
                           T.StructField("place", T.LongType())])
    raw = tag_race_role(read_csv_by_name(spark, str(tmp_path / "r.csv"), schema), "event",
                        ["CLASSIC 18K", "SKATE 18K"])
    main = drop_null(raw.filter(F.col("race_role") == "main"), ["place"])
    rows = main.unionByName(raw.filter(F.col("race_role") == "participation"))
    first, last = split_first_last(F.col("name"))
    res = rows.select(F.lit("finl").alias("event"), F.col("event").alias("race"), "race_role",
                      division_map("gender", "mf_else_null").alias("division"),
                      first.alias("first_name"), last.alias("last_name"), "age",
                      F.col("place").alias("division_place"))
    got = {(r.first_name, r.last_name): (r.division, r.points)
           for r in score_event(res, by=("event", "division")).collect()}
    # max place over both main races is 3: place 1 -> 100, 2 -> 66.67, 3 -> 33.33 (+ age bonus)
    assert got[("Ann", "Lee")] == ("female", 100.0) and got[("Cy", "Poe")] == ("female", 100.0)
    assert got[("Di", "Day")] == ("female", 66.666667) and got[("Eve", "Ash")] == ("female", 33.333333)
    assert got[("Fay", "Oak")] == ("female", 20.0) and got[("Gus", "Elm")] == (None, 20.0)
