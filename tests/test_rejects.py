"""What readers reject, and how odd documents and labels are read."""

import os
import tempfile

from pyspark.sql import types as T

from podium.sources import rejects
from podium.sources.files import file_layouts, read_lines
from podium.sources.nested import json_documents, read_json_rows, zip_labels


def _rows(df):
    return sorted(((r.source, r.line_no, r.raw, r.reason) for r in df.collect()), key=str)


def test_json_shapes_and_rejects(spark):
    bodies = ['{"data": [["a", 1.5, null, true], ["b"]]}', '{"data": {"r1": [["x"]], "r2": [], "r3": {"a": 1}}}', '{"data": 5}',
              "nope", None, '{"x": 1}', '{"data": null}', '{"data": [["ok"], 7]}', '{"data": []}', "", '{"data": {}}']
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc int, body string")
    got = {(r.doc, r.race_key, r.row_no): r.cells for r in read_json_rows(docs, keep=["doc"]).collect()}
    assert got == {(0, None, 0): ["a", "1.5", None, "true"], (0, None, 1): ["b"], (1, "r1", 0): ["x"], (7, None, 0): ["ok"]}
    assert {r.doc: r["__shape"] for r in json_documents(docs).collect()} == {
        0: "list", 1: "map", 2: "unknown shape", 3: "not json", 4: "not json", 5: "no data", 6: "no data", 7: "list",
        8: "list", 9: "not json", 10: "map"}
    assert _rows(rejects.json_rejects(docs, "doc")) == sorted([
        ("1", None, "r3", "race without rows"), ("2", None, bodies[2], "unknown shape"), ("3", None, "nope", "not json"),
        ("4", None, None, "not json"), ("5", None, bodies[5], "no data"), ("6", None, bodies[6], "no data"),
        ("7", 1, None, "row is no list"), ("9", None, "", "not json")], key=str)
    only = read_json_rows(docs, shape="map", keep=["doc"]).collect()
    assert [(r.doc, r.cells) for r in only] == [(1, ["x"])]


def test_repeated_and_blank_labels(spark):
    df = spark.createDataFrame([(["A", "B", "A", None, ""], ["t", "1", "2", "3"])], "labels array<string>, cells array<string>")
    assert zip_labels(df, "labels", offset=2).first().fields == {
        "A": "1", "B": "2", "A 3": "3", "column 4": None, "column 5": None}


def test_text_and_layout_rejects(spark):
    docs = spark.createDataFrame([(1, "x\nPos Name\n1 Ann\n\n2 Bo"), (2, "no head"), (3, None)], "doc int, t string")
    assert _rows(rejects.text_rejects(docs, "doc", "t", r"^(\d+) (.+)", "^Pos")) == sorted([
        ("1", 0, "x", "before header"), ("1", 1, "Pos Name", "header"), ("1", 3, "", "no match"),
        ("2", 0, "no head", "header not found")], key=str)
    rows = spark.createDataFrame([("f", 1, ["a"]), ("f", 2, ["a", "b"]), ("f", 3, None)], "file string, n int, cells array<string>")
    assert _rows(rejects.layout_rejects(rows, {2: ["x", "y"]}, "file", "n")) == sorted([
        ("f", 1, '["a"]', "1 cells"), ("f", 3, None, "0 cells")], key=str)


def test_header_pattern_repeated_on_a_long_line(spark):
    # a repeated group takes stack per turn: a line of many words ended the executor
    from podium.sources.markup import text_rows, without_header
    pattern, long = "^([^ ]+ ){9,}", "w " * 200_000 + "end"
    docs = spark.createDataFrame([(1, f"{long}\n1 Ann"), (2, "a b c d e f g h i"), (3, "1 2 3 4 5 6 7 8 9 \n2 Bo")], "doc int, t string")
    got = text_rows(docs, "t", r"^(\d+) (.+)", ["place", "name"], pattern, keep=["doc"]).collect()
    assert sorted((r.doc, r.line_no, r.place, r.name) for r in got) == [(1, 1, "1", "Ann"), (3, 1, "2", "Bo")]
    assert [r.doc for r in without_header(docs, "t", pattern).collect()] == [2]
    out = rejects.text_rejects(docs, "doc", "t", r"^(\d+) (.+)", pattern).select("source", "reason").collect()
    assert sorted(map(tuple, out)) == [("1", "header"), ("2", "header not found"), ("3", "header")]


def test_header_is_searched_once_per_document(spark):
    # behind the explode, the search would run through all lines of the document for each of them
    from podium.sources.markup import text_rows
    pattern = "^(HEAD ){2,}"
    docs = spark.createDataFrame([(1, "x\nHEAD HEAD \n1 Ann\nBo\n2 Cy"), (2, "1 Dee"), (3, None), (4, "")], "doc int, t string")
    rows = text_rows(docs, "t", r"^(\d+) (.+)", ["place", "name"], pattern, keep=["doc"])
    out = rejects.text_rejects(docs, "doc", "t", r"^(\d+) (.+)", pattern)
    for df in (rows, out):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("HEAD") == 1
    assert [tuple(r) for r in rows.collect()] == [(1, 2, "1", "Ann"), (1, 4, "2", "Cy")]
    assert [(r.source, r.line_no, r.reason) for r in out.collect()] == [
        ("1", 0, "before header"), ("1", 1, "header"), ("1", 3, "no match"), ("2", 0, "header not found"), ("4", 0, "header not found")]


def test_csv_casts_and_rejects(spark):
    root = tempfile.mkdtemp(prefix="podium-rej-")
    for name, text in (("a", "Place,Name\n1,Ann\nx,Bo\n\n,Cy\n"), ("b", "name\nDee\n")):
        with open(f"{root}/{name}.csv", "w") as f:
            f.write(text)
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("name", T.StringType())])
    lines = read_lines(spark, root)
    cast = rejects.csv_casts(lines, file_layouts(lines, {"place": "Place", "name": "Name"}), schema)
    assert sorted((r.row.place or 0, r.row.name) for r in cast.filter("reason IS NULL").collect()) == [(0, "Cy"), (1, "Ann")]
    got = [(os.path.basename(s), n, raw, why) for s, n, raw, why in _rows(rejects.csv_rejects(cast))]
    assert got == [("a.csv", 2, "x,Bo", "bad cell in place"), ("b.csv", 1, "Dee", "missing column place")]
