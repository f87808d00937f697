"""Distributed ranking vs window ranking; document sources; cleaning."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from podium.operators.clean import drop_status, resolve_columns, union_races
from podium.operators.place import distributed_dense_rank, distributed_rank
from podium.session import cut_lineage
from podium.sources.markup import html_rows, text_rows
from podium.sources.nested import apply_layouts, read_json_rows, zip_labels


def test_distributed_rank_matches_window_with_hot_group(spark):
    # one group holds most rows: it must still come out numbered 1..n
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
        .alias("grp"), (F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    mine = distributed_rank(df, ["grp"], [("v", "desc"), "id"], "r", num_partitions=8)
    w = Window.partitionBy("grp").orderBy(F.col("v").desc(), "id")
    ref = df.withColumn("r", F.row_number().over(w).cast("long"))
    assert mine.select("id", "r").exceptAll(ref.select("id", "r")).count() == 0
    assert mine.count() == 3000
    dense = distributed_dense_rank(df, ["grp"], ["v"], "d")
    ref_d = df.withColumn("d", F.dense_rank().over(Window.partitionBy("grp").orderBy("v")).cast("long"))
    assert dense.select("id", "d").exceptAll(ref_d.select("id", "d")).count() == 0


def test_json_shapes_and_layouts(spark):
    flat = json.dumps({"data": [["1", "x", "1.", "Ann LEE", "", "", "1st M", "", "0:59"], ["184"]]})
    keyed = json.dumps({"data": {"#1_52km": [["a", "b", "3", "Bo RAY", "", "M17-29 (1)", "", "1:00"]]}})
    docs = spark.createDataFrame([(1, flat), (2, keyed)], "doc int, body string")
    rows = read_json_rows(docs, "body", "auto", keep=["doc"])
    got = sorted((r.doc, r.race_key, r.row_no, len(r.cells)) for r in rows.collect())
    assert got == [(1, None, 0, 9), (1, None, 1, 1), (2, "#1_52km", 0, 8)]
    named = apply_layouts(rows, {9: [None, None, "place", "name"], 8: [None, None, "place", "name"]})
    assert sorted(r.name for r in named.collect()) == ["Ann LEE", "Bo RAY"]
    flagged = apply_layouts(rows, {9: ["a"]}, on_other="error")
    assert sorted(r.layout_ok for r in flagged.collect()) == [False, False, True]
    lab = spark.createDataFrame([(["P", "N"], ["x", "1", "Ann"])], "labels array<string>, cells array<string>")
    assert zip_labels(lab, "labels", offset=2).collect()[0].fields == {"P": "1", "N": "Ann"}


def test_html_and_text_rows(spark):
    html = ("<table><thead><tr><th>Place</th><th>Name</th></tr></thead><tbody>"
            "<tr><td> 1 </td><td>Ann Lee</td></tr><tr><td>2</td><td>Bo Ray</td></tr></tbody></table>")
    pages = spark.createDataFrame([(1, html), (2, "<table><tbody></tbody></table>")], "id int, html string")
    rows = html_rows(pages, keep=["id"]).collect()
    assert [r.cells for r in rows] == [["Place", "Name"], ["1", "Ann Lee"], ["2", "Bo Ray"]]
    text = "Results 2025\nnoise\nPlace Name\n1 Ann O'Neil-Lee\nbad line\n2 Bo Ray"
    docs = spark.createDataFrame([(1, text)], "id int, t string")
    out = text_rows(docs, "t", r"^(\d+) (.+)$", ["place", "name"], header_pat=r"^Place ", keep=["id"]).collect()
    assert [(r.place, r.name) for r in out] == [("1", "Ann O'Neil-Lee"), ("2", "Bo Ray")]


def test_cleaning_helpers(spark):
    df = spark.createDataFrame([(" Overall Place", "x"), ("DNF", "y")], "` Overall Place` string, `NAME ` string")
    res = resolve_columns(df, {"place": "overall place", "name": "name"})
    assert res.columns == ["place", "name"]
    try:
        resolve_columns(df, {"age": "Age"})
        raise AssertionError("expected failure")
    except ValueError as e:
        assert "Age" in str(e)
    assert drop_status(res, "place").count() == 1
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([(2, "x")], "k int, extra string")
    u = union_races([a, b], ["r1", "r2"]).orderBy("k").collect()
    assert [(r.k, r.extra, r.race) for r in u] == [(1, None, "r1"), (2, "x", "r2")]


def test_fields_map_first_entry_only(spark):
    from podium.sources.nested import fields_map_rows
    doc = json.dumps({"list": {"Fields": [{"Label": "Place"}, {"Label": "Name"}]},
                      "data": {"#1_Main": [["r", "1", "Ann"], ["r", "2", "Bo"]], "#2_Other": [["r", "9", "Zed"]]}})
    rows = fields_map_rows(spark.createDataFrame([(doc,)], "body string"))
    z = zip_labels(rows, "labels", offset=2).collect()
    assert [(r.race_key, r.fields["Place"], r.fields["Name"]) for r in z] == [("#1_Main", "1", "Ann"), ("#1_Main", "2", "Bo")]


def test_open_class_list_per_source(spark):
    from podium.functions.division import age_class_dash
    df = spark.createDataFrame([("M70+",), ("F75+",), ("M16-18",)], "v string")
    only75 = [r.a for r in df.select(age_class_dash("v", open_classes=(("75+", 75),)).alias("a")).collect()]
    assert [(a.age, a.division) if a else None for a in only75] == [None, (75, "female"), (17, "male")]


def test_distributed_rank_default_slices(spark):
    """Default slice count (AQE may merge small slices): same numbering as the window."""
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 37) % 500).alias("v"), "id")
    mine = distributed_rank(df, ["g"], ["v", "id"], "r")
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("long"))
    assert mine.select("id", "r").exceptAll(ref.select("id", "r")).count() == 0
    assert mine.count() == 2000


def test_summary_too_large_to_broadcast_is_shuffled(spark):
    """Above the planner's threshold the offsets are joined by a shuffle; numbering is unchanged."""
    df = spark.range(0, 1500).select((F.col("id") % 50).alias("g"), ((F.col("id") * 7) % 300).alias("v"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mine = cut_lineage(distributed_rank(df, ["g"], ["v", "id"], "r", num_partitions=6))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("long"))
    assert mine.select("id", "r").exceptAll(ref.select("id", "r")).count() == 0


def test_fixed_text_results_shape(spark):
    """S8 on the fixed-layout result text, then N14/N15/N8 on the cut columns."""
    from podium.functions.division import division_map
    from podium.functions.numbers import clock_seconds, lenient_int
    text = "\n".join([
        "Lake Race 2025 - 10 km",
        "1 99/99 999 Not A Result line before the header",
        "Place DivPl Bib  Name                 Age S City          St Time     Pace",
        "    1   1/12 101 Ann O'Neil-Lee        34 F Duluth        MN 41:02.5  6:36",
        "    2   1/30 117 Bo Ray                 51 M Ely           MN 1:02:03  9:59",
        "  DNF        118 Cy Poe                 40 M Ely           MN",
        "    3   2/12 130 Di Day                 29 F Two Harbors   MN 45:00.0  7:15",
    ])
    pat = (r"^\s*(\d+)\s+(\d+)/(\d+)\s+(\d+)\s+(.+?)\s+(\d+)\s+([MF])\s+(.+?)\s+([A-Z]{2})"
           r"\s+([\d:.]+)\s+([\d:.]+)$")
    names = ["place", "div_place", "div_size", "bib", "name", "age", "sex", "city", "st", "time", "pace"]
    docs = spark.createDataFrame([(1, text)], "doc int, body string")
    rows = text_rows(docs, "body", pat, names, header_pat=r"^Place\s+DivPl", keep=["doc"])
    out = rows.select("name", lenient_int("place").alias("place"), lenient_int("age").alias("age"),
                      division_map("sex", "strict").alias("division"), "city",
                      clock_seconds("time").alias("time_s")).collect()
    assert [(r.name, r.place, r.age, r.division, r.city, r.time_s) for r in out] == [
        ("Ann O'Neil-Lee", 1, 34, "female", "Duluth", 2462.5),
        ("Bo Ray", 2, 51, "male", "Ely", 3723.0),
        ("Di Day", 3, 29, "female", "Two Harbors", 2700.0)]


def test_relay_html_table_flow(spark):
    """S7 -> S6 -> P6 -> L1/L2 -> N15 -> R3 on a relay result table (two racers per row)."""
    from podium.functions.numbers import clock_seconds
    from podium.operators.clean import patch_rows
    from podium.operators.place import place_dense
    from podium.operators.relay import relay_division, relay_stretch
    body = [("Ann Lee &", "Bo Ray", "Mixed", "1:00:00"), ("Cy Poe &", "Di Day", "Female", "1:00:00"),
            ("Ed Fox &", "Al Kim", "Male", "1:05:00"), ("Fa Wu &", "Gi Ho", "Female", "1:10:00")]
    html = ("<table class='results'><thead><tr><th> First Name</th><th>Last Name</th><th>Class</th>"
            "<th>Total Time</th></tr></thead><tbody>"
            + "".join("<tr>" + "".join(f"<td> {c} </td>" for c in r) + "</tr>" for r in body)
            + "</tbody></table>")
    rows = html_rows(spark.createDataFrame([(1, html)], "page int, html string"), keep=["page"])
    header = rows.filter(F.col("row_no") == 0).select("page", F.col("cells").alias("labels"))
    data = zip_labels(rows.filter(F.col("row_no") > 0).join(header, "page"), "labels")
    wide = data.select(F.col("fields")["First Name"].alias("first"), F.col("fields")["Last Name"].alias("last"),
                       F.col("fields")["Class"].alias("class"),
                       clock_seconds(F.col("fields")["Total Time"]).alias("time_s"))
    wide = patch_rows(wide, (F.col("class") == "Female") & (F.col("first") == "Cy Poe &"), "class", "Mixed")
    lookup = spark.createDataFrame([("Ann Lee", "female"), ("Bo Ray", "male"), ("Cy Poe", "male"),
                                    ("Di Day", "female")], "name string, division string")
    racers = relay_division(relay_stretch(wide, ["first", "last"]), "class", lookup,
                            {"Male": "male", "Female": "female"})
    placed = place_dense(racers, ["division"], "time_s", "division_place")
    got = sorted((r.division, r.division_place, r.member_name) for r in placed.collect())
    assert got == [("female", 1, "Ann Lee"), ("female", 1, "Di Day"), ("female", 2, "Fa Wu"),
                   ("female", 2, "Gi Ho"), ("male", 1, "Bo Ray"), ("male", 1, "Cy Poe"),
                   ("male", 2, "Al Kim"), ("male", 2, "Ed Fox")]


def test_keyed_json_results_flow(spark):
    """S4 -> S5 -> P3 -> N1/N6 -> N10-N13 -> R4 + Q4 on a keyed JSON page with 9- and 8-cell rows."""
    from podium.functions.division import age_class_dash
    from podium.functions.numbers import first_int
    from podium.functions.text import capitalize_parts, split_first_rest
    from podium.operators.place import place_in_division
    from podium.operators.quality import guard_partition
    rows9 = [["11", "x", "1", "Ann LEE-SMITH", "Ely, MN", "F17-29 (1)", "09:00", "0:40", "1:20:00"],
             ["12", "x", "DNF", "Bo RAY", "", "M30-34 (1)", "09:00", "", ""],
             ["13", "x", "2", "Cy o'POE", "", "M70+", "09:00", "0:41", "1:21:00"]]
    rows8 = [["14", "x", "3", "Di DAY", "", "F50-55 (2)", "09:00", "1:25:00"],
             ["15", "x", "*", "Ed FOX", "", "M16-18", "09:00", "1:30:00"],
             ["16", "x", "4", "Al KIM", "", "M16-18", "09:00", "1:31:00"]]
    doc = json.dumps({"data": {"#1_52km Freestyle": rows9 + rows8}})
    parsed = read_json_rows(spark.createDataFrame([(doc,)], "body string"), "body", "map")
    named = apply_layouts(parsed, {
        9: ["bib", None, "overall", "name", "city", "class", None, None, "time"],
        8: ["bib", None, "overall", "name", "city", "class", None, "time"]}, on_other="drop")
    finishers = drop_status(named, "overall")
    first, rest = split_first_rest("name")
    ac = age_class_dash("class")
    res = finishers.select(first.alias("first_name"), capitalize_parts(rest).alias("last_name"),
                           first_int("overall").alias("overall_place"), ac["age"].alias("age"),
                           ac["division"].alias("division"))
    placed = place_in_division(res, ["division"], ["overall_place"])
    got = sorted((r.division, r.division_place, r.first_name, r.last_name, r.age) for r in placed.collect())
    assert got == [("female", 1, "Ann", "Lee-Smith", 23), ("female", 2, "Di", "Day", 52),
                   ("male", 1, "Cy", "O'Poe", 70), ("male", 2, "Al", "Kim", 16)]
    check = guard_partition(res, "division", ["male", "female"]).collect()[0]
    assert (check.n_rows, check.n_male, check.n_female, check.complete) == (4, 2, 2, True)


def test_flat_json_words_grammar_flow(spark):
    """S3 -> S5 (drop other lengths) -> P3 -> N4 -> N10 (words) -> N13 on a flat 12-cell list."""
    from podium.functions.division import age_class_words
    from podium.functions.numbers import first_int
    from podium.functions.text import split_caps_surname
    row = lambda place, name, gplace, cls: ["b", "x", place, name, "Ely", "", gplace, cls, "", "", "1:00", ""]
    data = [row("1", "Anna Maria SMITH-JONES", "Female (1)", "F 35 to 39 (1)"),
            row("2", "Bo RAY", "Male (1)", "Male (2)"),
            row("DNS", "Cy POE", "Male (*)", "M 40 to 44 (1)"),
            row("3", "Di O'DAY", "Male (*)", "M 50 to 54 (1)"),
            row("4", "Ed FOX", "Male (2)", "M  70 and over"),
            ["184"]]
    doc = json.dumps({"data": data})
    rows = read_json_rows(spark.createDataFrame([(doc,)], "body string"), "body", "list")
    named = apply_layouts(rows, {12: [None, None, "overall", "name", None, None, "gplace", "class"]})
    first, last, ok = split_caps_surname(F.col("name"))
    ac = age_class_words("class")
    res = (drop_status(named, "overall")
           .select(first.alias("first"), last.alias("last"), first_int("gplace").alias("division_place"),
                   ac["age"].alias("age"), ac["division"].alias("division"))
           .filter(F.col("division_place").isNotNull()))  # 'Male (*)' has no place: row dropped
    got = sorted((r.first, r.last, r.division, r.division_place, r.age) for r in res.collect())
    assert got == [("Anna Maria", "Smith-Jones", "female", 1, 37), ("Bo", "Ray", "male", 1, None),
                   ("Ed", "Fox", "male", 2, 70)]


def test_html_results_table_flow(spark):
    """S7 -> N5 -> N7 -> N14 -> N16 -> R2 on paged HTML result tables (one page empty)."""
    from podium.functions.division import division_from_prefix
    from podium.functions.numbers import lenient_int
    from podium.functions.text import full_name, split_human
    from podium.operators.place import place_in_division
    head = "<thead><tr>" + "".join(f"<th>{h}</th>" for h in
                                   ["Place", "Name", "Sex", "Age", "City", "State", "Time"]) + "</tr></thead>"
    body = [(" 1 ", "Dr. Ann Lee", "F", "34", "Duluth", "MN", "40:00"), ("2", "Bo Ray Jr.", "M", " ", "Ely", "MN", "41:00"),
            ("3", "Cy Poe", "m", "51", None, "WI", "42:00"), ("4", "Di Day", "Female", "29", "Ely", "MN", "43:00")]
    trs = "".join("<tr>" + "".join(f"<td>{c if c is not None else ''}</td>" for c in r) + "</tr>" for r in body)
    pages = spark.createDataFrame([(1, f"<table>{head}<tbody>{trs}</tbody></table>"),
                                   (2, f"<table>{head}<tbody></tbody></table>")], "page int, html string")
    rows = html_rows(pages, keep=["page"]).filter(F.col("row_no") > 0)
    c = lambda i: F.get("cells", i)
    first, last = split_human(c(1))
    city = F.when(c(4) != "", c(4))
    res = rows.select(lenient_int(c(0)).alias("overall"), first.alias("first_name"), last.alias("last_name"),
                      division_from_prefix(c(2)).alias("division"), lenient_int(c(3)).alias("age"),
                      full_name(city, c(5), ", ").alias("location"))
    placed = place_in_division(res, ["division"], ["overall"])
    got = sorted((r.division, r.division_place, r.first_name, r.last_name, r.age, r.location)
                 for r in placed.collect())
    assert got == [("female", 1, "Ann", "Lee", 34, "Duluth, MN"), ("female", 2, "Di", "Day", 29, "Ely, MN"),
                   ("male", 1, "Bo", "Ray", None, "Ely, MN"), ("male", 2, "Cy", "Poe", 51, None)]


def test_hot_group_spreads_over_slices(spark):
    """The range exchange used by distributed_rank cuts a group holding 80% of the rows into slices."""
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 5 < 4, F.lit("hot")).otherwise(F.lit("cold")).alias("grp"), F.col("id").alias("v"))
    keys = [F.col("grp").asc_nulls_first(), F.col("v").desc()]
    sliced = df.repartitionByRange(8, *keys).withColumn("pid", F.spark_partition_id())
    per = {r.grp: r.n for r in sliced.groupBy("grp").agg(F.countDistinct("pid").alias("n")).collect()}
    assert per["hot"] >= 5
    biggest = max(r["count"] for r in sliced.filter(F.col("grp") == "hot").groupBy("pid").count().collect())
    assert biggest < 3200 / 3  # no slice holds more than a third of the hot group
