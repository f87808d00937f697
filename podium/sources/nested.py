"""Nested result documents (S3-S6): JSON pages of positional rows.

The fetched payloads sit one document per row in a text column; parsing is
``from_json`` with a fixed schema, rows come out by ``posexplode`` so the position
in the document is kept as data (``row_no``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.text import distinct_names

ROWS = T.ArrayType(T.ArrayType(T.StringType()))
FIELDS_DOC = T.StructType([
    T.StructField("list", T.StructType([T.StructField(
        "Fields", T.ArrayType(T.StructType([T.StructField("Label", T.StringType())])))])),
    T.StructField("data", T.MapType(T.StringType(), ROWS)),
])
LABELLED_DOC = T.StructType([
    T.StructField("headings", T.ArrayType(T.StructType([T.StructField("key", T.StringType())]))),
    T.StructField("resultSet", T.StructType([T.StructField("results", ROWS)])),
])


def read_text_docs(spark, path: str, name: str = "body") -> DataFrame:
    """One document per file (whole text), with the file name as ``source``."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("source"), F.col("value").alias(name)))


def json_documents(docs: DataFrame, body: str = "body", shape: str = "auto") -> DataFrame:
    """``docs`` with ``__shape`` and ``__entries``; each body is parsed once, into a variant.

    ``__shape`` is ``list`` for ``{"data": [[...], ...]}``, ``map`` for ``{"data": {race: [[...]]}}``, by the
    variant's own schema, and otherwise the reason why a body is none of the shapes asked for:
    ``not json``, ``no data`` or ``unknown shape``. ``__entries`` are (race, rows).
    """
    if shape not in ("auto", "list", "map"):
        raise ValueError(f"unknown shape {shape}")
    parsed = docs.withColumn("__variant", F.try_parse_json(F.col(body)))
    data = F.try_variant_get(F.col("__variant"), "$.data", "variant")
    form = F.schema_of_variant(data)
    kind = (F.when(F.col("__variant").isNull(), "not json").when(data.isNull() | F.is_variant_null(data), "no data")
            .when(form.rlike(r"^ARRAY<(ARRAY<|VOID|VARIANT)") & F.lit(shape != "map"), "list")
            .when(form.startswith("OBJECT<") & F.lit(shape != "list"), "map").otherwise("unknown shape"))
    races = T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", ROWS)]))
    one = F.array(F.struct(F.lit(None).cast("string").alias("k"), F.try_variant_get(data, "$", "array<array<string>>").alias("v")))
    many = F.map_entries(F.try_variant_get(data, "$", "map<string,array<array<string>>>")).cast(races)
    entries = F.when(F.col("__shape") == "list", one.cast(races)).when(F.col("__shape") == "map", many)
    return parsed.withColumn("__shape", kind).withColumn("__entries", entries).drop("__variant")


def read_json_rows(docs: DataFrame, body: str = "body", shape: str = "auto",
                   keep: Sequence[str] = ()) -> DataFrame:
    """JSON documents -> (keep..., race_key, row_no, cells).

    ``list``: ``{"data": [[...], ...]}`` (race_key null); ``map``: ``{"data": {race:
    [[...]]}}``; ``auto``: each document by its own shape. Documents of no such shape, rows that are no
    lists and races without a list give no rows here: ``rejects.json_rejects`` returns them.
    """
    races = json_documents(docs, body, shape).select(*keep, F.explode("__entries").alias("__e"))
    rows = races.select(*keep, F.col("__e.k").alias("race_key"), F.posexplode("__e.v").alias("row_no", "cells"))
    return rows.filter(F.col("cells").isNotNull())


def apply_layouts(rows: DataFrame, layouts: Mapping[int, Sequence[str | None]],
                  cells: str = "cells", on_other: str = "drop") -> DataFrame:
    """Name positional cells by row length; other lengths are dropped or flagged.

    ``layouts`` maps a row length to the column name of each position (None = skip).
    Every name used by any layout becomes a column (null where a layout lacks it).
    ``on_other='error'`` keeps the rows with ``layout_ok = false`` for quarantine.
    """
    names = []
    for layout in layouts.values():
        for n in layout:
            if n and n not in names:
                names.append(n)
    size = F.size(F.col(cells))
    cols = {}
    for n in names:
        expr = None
        for length, layout in layouts.items():
            if n in layout:
                pos = list(layout).index(n)
                cond = size == F.lit(length)
                val = F.get(F.col(cells), pos)
                expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        cols[n] = expr
    known = size.isin(*layouts.keys())
    out = rows.withColumns(cols)
    if on_other == "drop":
        return out.filter(known)
    return out.withColumn("layout_ok", known)


def zip_labels(rows: DataFrame, labels: Column | str, cells: str = "cells",
               offset: int = 1, length: int | None = None) -> DataFrame:
    """Name a positional slice of each row by a label list from the document.

    Adds a ``fields`` map label -> cell for cells ``offset .. offset+length-1``
    (1-based); read single fields with ``fields[label]``. A label that came before and a blank one
    are named as in ``distinct_names``; a row that ends early has null fields.
    """
    lab = F.col(labels) if isinstance(labels, str) else labels
    keys = lab if length is None else F.slice(lab, 1, length)
    return rows.withColumn("fields", F.map_from_arrays(distinct_names(keys), F.transform(
        keys, lambda _, i: F.get(F.col(cells), i + F.lit(offset - 1)))))


def labelled_rows(docs: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """S6 source form: ``{"headings": [{"key": ..}], "resultSet": {"results": [[..]]}}``."""
    doc = F.from_json(F.col(body), LABELLED_DOC)
    parsed = docs.select(*keep, F.transform(doc["headings"], lambda h: h["key"]).alias("labels"),
                         doc["resultSet"]["results"].alias("__rows"))
    return parsed.select(*keep, "labels", F.posexplode("__rows").alias("row_no", "cells"))


def fields_map_rows(docs: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """S6 second form: ``{"list": {"Fields": [{"Label": ..}]}, "data": {race: [[..]]}}``.

    Labels come from the field list; rows from the first entry of the ``data`` map only.
    """
    doc = F.from_json(F.col(body), FIELDS_DOC)
    first = F.get(F.map_entries(doc["data"]), 0)
    parsed = docs.select(*keep, F.transform(doc["list"]["Fields"], lambda f: f["Label"]).alias("labels"),
                         first["key"].alias("race_key"), first["value"].alias("__rows"))
    return parsed.select(*keep, "labels", "race_key", F.posexplode("__rows").alias("row_no", "cells"))
