"""CSV hand-over tables: write event points per (season, event, division), read back."""

import os
import tempfile

from pyspark.sql import functions as F

from podium.schema import EVENT_POINTS
from podium.sources.files import load_event_points, read_csv_table, write_event_points, write_report


def test_round_trip_with_missing_partition(spark):
    rows = [("s1", "e1", "female", "Ann", "Lee", 30, 1, "main", 100.0),
            ("s1", "e1", "female", "Bo", "Ray", None, None, "participation", 20.0),
            ("s1", "e2", "male", "Cy", "Poe", 50, 1, "main", 100.0)]
    pts = spark.createDataFrame(rows, EVENT_POINTS)
    root = tempfile.mkdtemp(prefix="podium-db-")
    write_event_points(pts, root)
    assert os.path.isdir(f"{root}/season=s1/event=e1/division=female")
    assert not os.path.exists(f"{root}/season=s1/event=e2/division=female")  # absent -> no rows
    back = load_event_points(spark, root, "s1")
    got = sorted((r.event, r.division, r.first_name, r.race_role, r.division_place, r.age, r.points)
                 for r in back.collect())
    assert got == [("e1", "female", "Ann", "main", 1, 30, 100.0),
                   ("e1", "female", "Bo", "participation", None, None, 20.0),
                   ("e2", "male", "Cy", "main", 1, 50, 100.0)]
    empty = load_event_points(spark, f"{root}/nothing-here")
    assert empty.count() == 0 and empty.schema == EVENT_POINTS


def test_read_csv_with_schema_and_report(spark):
    d = tempfile.mkdtemp(prefix="podium-csv-")
    with open(f"{d}/r.csv", "w") as f:
        f.write('place,name,location\n1,Ann Lee,"Duluth, MN"\nx,Bo Ray,\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("location", T.StringType())])
    df = read_csv_table(spark, f"{d}/r.csv", schema)
    got = sorted(((r.place, r.name, r.location) for r in df.collect()), key=lambda t: t[1])
    assert got == [(1, "Ann Lee", "Duluth, MN"), (None, "Bo Ray", None)]
    out = f"{d}/report"
    write_report(df, out, {"place": "Overall Place", "name": "Name"}, order=[F.col("name")])
    header = open([os.path.join(out, p) for p in os.listdir(out) if p.endswith(".csv")][0]).readline()
    assert header.strip() == "Overall Place,Name,location"


def test_cluster_conf_sizes_partitions():
    from podium.session import cluster_conf
    c = cluster_conf(100 << 40, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(cluster_conf(1 << 30, executors=10)["spark.sql.shuffle.partitions"]) == 80


def test_event_points_file_with_quoted_location(spark):
    root = tempfile.mkdtemp(prefix="podium-loc-")
    d = f"{root}/season=s1/event=e1/division=male"
    os.makedirs(d)
    with open(f"{d}/part-0.csv", "w") as f:
        f.write('gender_place,first_name,last_name,age,age_advantage_event_points,location\n'
                '1,Cy,Poe,50,100.0,"Ely, MN"\n999,Ed,Fox,999,20.0,"Duluth, MN"\n')
    got = sorted((r.first_name, r.race_role, r.division_place, r.points)
                 for r in load_event_points(spark, root).collect())
    assert got == [("Cy", "main", 1, 100.0), ("Ed", "participation", None, 20.0)]


def test_event_points_bound_by_header_name(spark):
    """Column order is free, location survives, and age and place sentinels are independent."""
    root = tempfile.mkdtemp(prefix="podium-head-")
    for event, text in (("e1", "location,age,gender_place,first_name,last_name,age_advantage_event_points\n"
                               "Ely,999,5,Cy,Poe,88.5\n"),
                        ("e2", "gender_place,first_name,last_name,age,age_advantage_event_points\n999,Ed,Fox,30,20\n")):
        d = f"{root}/season=s1/event={event}/division=male"
        os.makedirs(d)
        with open(f"{d}/part-0.csv", "w") as f:
            f.write(text)
    got = sorted((r.event, r.first_name, r.age, r.division_place, r.race_role, r.points, r.location)
                 for r in load_event_points(spark, root, with_location=True).collect())
    assert got == [("e1", "Cy", None, 5, "main", 88.5, "Ely"),
                   ("e2", "Ed", 30, None, "participation", 20.0, None)]


def test_writing_a_season_leaves_the_others(spark):
    root = tempfile.mkdtemp(prefix="podium-two-")

    def season(name, events):
        return spark.createDataFrame([(name, e, "male", "Cy", "Poe", 50, 1, "main", 100.0) for e in events],
                                     EVENT_POINTS)

    write_event_points(season("old", ["e1", "e2"]), root)
    write_event_points(season("new", ["e1", "e2"]), root)
    write_event_points(season("new", ["e2"]), root)  # e1 is gone from the new season
    got = sorted((r.season, r.event) for r in load_event_points(spark, root).collect())
    assert got == [("new", "e2"), ("old", "e1"), ("old", "e2")]


def _points(spark, keys):
    rows = [(s, e, d, f"N{i}", "Poe", 50, i + 1, "main", 90.5 + i) for i, (s, e, d) in enumerate(keys)]
    return spark.createDataFrame(rows, EVENT_POINTS)


def test_keys_with_special_characters_survive_a_rewrite(spark):
    """Folder names are escaped, a null key lies in the default folder: none of them is stale."""
    root = tempfile.mkdtemp(prefix="podium-esc-")
    keys = [("25/26", "ski:classic", "male"), ("25/26", "a%2Fb c+d", None), ("25/26", "x=y", "f\u00e9m"), ("24/25", "old", "male")]
    order = lambda ks: sorted(ks, key=str)
    write_event_points(_points(spark, keys), root)
    read = lambda season=None: order((r.season, r.event, r.division) for r in load_event_points(spark, root, season).collect())
    assert read() == order(keys)
    assert read("25/26") == order(keys[:3]) and read("24/25") == keys[3:]
    write_event_points(_points(spark, keys[:1] + [("25/26", "new", None)]), root)
    assert read() == order([keys[0], ("25/26", "new", None), keys[3]])
    write_event_points(_points(spark, [("25/26", None, "male")]), root)
    assert read() == order([("25/26", None, "male"), keys[3]])


def test_folders_and_layouts_load_in_a_fixed_number_of_jobs(spark):
    """Files of different layouts in one folder, and many folders: the same jobs as for one."""
    heads = ("location,age,gender_place,first_name,last_name,age_advantage_event_points",
             "gender_place,first_name,last_name,age, Age_Advantage_Event_Points ")
    lines = ('"Ely, ""MN""",41,5,Cy,Poe,88.5\n\n', "5,Cy,Poe,41,88.5\n999,,Ray,x,20\n")

    def folders(n):
        root = tempfile.mkdtemp(prefix="podium-many-")
        for i in range(n):
            d = f"{root}/season=25%2F26/event=e{i}/division=male"
            os.makedirs(d)
            for k in range(2):
                with open(f"{d}/part-{k}.csv", "w") as f:
                    f.write(f"{heads[k]}\n{lines[k]}")
            open(f"{d}/part-2.csv", "w").close()
        return root

    def jobs(root, group):
        sc = spark.sparkContext
        sc.setJobGroup(group, group)
        rows = load_event_points(spark, root, "25/26", with_location=True).collect()
        n = len(sc.statusTracker().getJobIdsForGroup(group))
        sc.setJobGroup("", "")
        return rows, n

    few, n_few = jobs(folders(40), "few-folders")
    many, n_many = jobs(folders(400), "many-folders")
    assert n_many <= n_few + 1 and len(many) == 1200 and len(few) == 120
    got = {(r.first_name, r.age, r.division_place, r.race_role, r.points, r.location) for r in many}
    assert got == {("Cy", 41, 5, "main", 88.5, 'Ely, "MN"'), ("Cy", 41, 5, "main", 88.5, None),
                   (None, None, None, "participation", 20.0, None)}


def test_a_file_without_a_required_column_raises(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="podium-miss-")
    os.makedirs(f"{root}/season=s/event=e/division=male")
    with open(f"{root}/season=s/event=e/division=male/a.csv", "w") as f:
        f.write("gender_place,first_name\n1,Cy\n")
    with pytest.raises(ValueError, match="last_name"):
        load_event_points(spark, root)
