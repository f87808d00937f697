"""Small helpers: quarantine split, guards that raise, zero fill, whole-file documents, location."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from podium.operators.clean import fill_zero, quarantine_unknown_division
from podium.operators.quality import quarantine, raise_if_any, reason_counts
from podium.operators.season import guard_events
from podium.sources.nested import read_json_rows, read_text_docs


def test_quarantine_split_and_counts(spark):
    df = spark.createDataFrame([(1, "M17-29"), (2, None), (3, "x")], "id int, cls string")
    reasons = {"no_class": F.col("cls").isNull(), "unreadable": ~F.col("cls").rlike("^[MF][0-9]")}
    clean, rejected = quarantine(df, reasons)
    assert [r.id for r in clean.collect()] == [1]
    assert sorted((r.id, r.reject_reason) for r in rejected.collect()) == [(2, "no_class"), (3, "unreadable")]
    counts = sorted((r.reason, r.n_rows) for r in reason_counts(df, reasons).collect())
    assert counts == [("no_class", 1), ("ok", 1), ("unreadable", 1)]


def test_raise_if_any_and_guard_events(spark):
    raise_if_any(spark.range(0), "nothing wrong")
    with pytest.raises(ValueError, match="two people"):
        raise_if_any(spark.range(3).withColumnRenamed("id", "n"), "two people, one name", show=2)
    with pytest.raises(ValueError):
        guard_events([])
    with pytest.raises(ValueError):
        guard_events(["e1", "e2"], [object()])
    guard_events(["e1"], [object()])


def test_fill_zero_and_unknown_division(spark):
    df = spark.createDataFrame([("male", None), ("X", 3.0), (None, 1.0)], "division string, p double")
    assert [r.p for r in fill_zero(df, ["p"]).collect()] == [0.0, 3.0, 1.0]
    ok, bad = quarantine_unknown_division(df)
    assert ok.count() == 1 and bad.count() == 2


def test_read_text_docs_whole_files(spark):
    d = tempfile.mkdtemp(prefix="podium-docs-")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"data": [["1", "x"],\n ["2", "y"]]}')
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('{"data": {"race": [["3"]]}}')
    docs = read_text_docs(spark, d)
    rows = read_json_rows(docs, keep=["source"])
    got = sorted((os.path.basename(r.source), r.race_key, r.row_no, r.cells[0]) for r in rows.collect())
    assert got == [("a.json", None, 0, "1"), ("a.json", None, 1, "2"), ("b.json", "race", 0, "3")]


def test_write_event_points_with_location(spark):
    from podium.sources.files import write_event_points
    df = spark.createDataFrame([("s1", "e1", "male", "Cy", "Poe", 50, 1, "main", 100.0, "Ely, MN")],
                               "season string, event string, division string, first_name string, last_name string, "
                               "age int, division_place long, race_role string, points double, location string")
    root = tempfile.mkdtemp(prefix="podium-wloc-")
    write_event_points(df, root, with_location=True)
    folder = f"{root}/season=s1/event=e1/division=male"
    text = open(os.path.join(folder, [p for p in os.listdir(folder) if p.endswith(".csv")][0])).read()
    assert text.splitlines()[0] == "gender_place,first_name,last_name,age,age_advantage_event_points,location"
    assert '"Ely, MN"' in text


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Ctx:
    def __init__(self, master, conf_value):
        self.master, self.dir, self._conf = master, None, _Conf(conf_value)

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, conf_value=None):
        self.sparkContext = _Ctx(master, conf_value)
        self.conf = _Conf(conf_value)


def test_checkpoint_folder_rules():
    from podium.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(_Session("yarn", "hdfs://shared/ckpt")) == "hdfs://shared/ckpt"
    local = _Session("local[4]")
    assert ensure_checkpoint_dir(local).startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_window_rank_kinds(spark):
    from podium.operators.place import window_rank
    df = spark.createDataFrame([("t", 5), ("t", 5), ("t", 3)], "g string, v int")
    for kind, want in (("row_number", [1, 2, 3]), ("rank", [1, 1, 3]), ("dense_rank", [1, 1, 2])):
        got = sorted(r.r for r in window_rank(df, ["g"], [("v", "desc")], "r", kind).collect())
        assert got == want, kind


def test_entry_keeps_its_keys_without_the_corpus_operators():
    """A missing library, a left-over folder without modules, or no folder at all."""
    import os
    import subprocess
    import sys
    import tempfile
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for left in ("nothing", "folder", "broken"):
        copy = tempfile.mkdtemp(prefix="podium-entry-")
        for path, _, names in os.walk(f"{root}/podium"):
            if path.split("/")[-1] in ("llm", "__pycache__"):
                continue
            os.makedirs(path.replace(root, copy), exist_ok=True)
            for n in names:
                with open(f"{path}/{n}", "rb") as a, open(f"{path.replace(root, copy)}/{n}", "wb") as b:
                    b.write(a.read())
        with open(f"{root}/__spark_entry__.py") as a, open(f"{copy}/__spark_entry__.py", "w") as b:
            b.write(a.read())
        if left != "nothing":
            os.makedirs(f"{copy}/podium/llm")
        if left == "broken":
            for n, text in (("__init__", ""), ("oracle", "SQL = {}"), ("queries", "import no_such_library")):
                with open(f"{copy}/podium/llm/{n}.py", "w") as f:
                    f.write(text)
        code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), any(k[:2] == 'op' and k[2].isdigit() for k in q))"
        out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=copy, capture_output=True, text=True,
                             env=os.environ | {"PYTHONPATH": copy})
        assert out.stdout.split()[1:] == ["True", "False"] and int(out.stdout.split()[0]) >= 60, out.stderr
