"""One channel for everything that a reader could not turn into rows (Q3 with S1, S3-S5, S8).

Each function is the complement of a reader: every input line, row or document is either in the
reader's result or here, as (reader, source, line_no, raw, reason). The tables have one schema,
so a job unites them, writes them next to its results and checks that nothing went missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.schema import REJECTS
from podium.sources.files import bind_by_header
from podium.sources.markup import numbered_lines
from podium.sources.nested import json_documents


def _rejects(df: DataFrame, reader: str, source, line_no, raw, reason) -> DataFrame:
    cols = (F.lit(reader), source, line_no, raw, reason)
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, REJECTS.fields)])


def _none() -> Column:
    return F.lit(None)


def csv_casts(lines: DataFrame, layouts: DataFrame, schema: T.StructType, optional: Sequence[str] = (),
              keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., file, line_no, line, row, reason): data lines cast to ``schema``.

    ``reason`` is null, ``missing column <c>`` or ``bad cell in <c>`` (the first such column); a
    cell is bad if it holds text that its type cannot read. Lines of a block behind a file's first one have no number.
    """
    bound = bind_by_header(lines, layouts, keep=[*keep, "line", "block_start", "head_id"])
    cell = {f.name: F.try_element_at("cells", F.lit(f.name)) for f in schema.fields}
    row = F.struct(*[cell[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    reason = F.coalesce(*[F.when(~F.map_contains_key("cells", f.name), F.lit(f"missing column {f.name}"))
                          for f in schema.fields if f.name not in optional],
                        *[F.when(F.trim(cell[f.name]).isNotNull() & (F.trim(cell[f.name]) != "")
                                 & cell[f.name].try_cast(f.dataType).isNull(), F.lit(f"bad cell in {f.name}"))
                          for f in schema.fields])
    number = F.when(F.col("block_start") == 0, F.col("line_id") - F.col("head_id"))
    return bound.select(*keep, "file", number.cast("long").alias("line_no"), "line", row.alias("row"), reason.alias("reason"))


def csv_rejects(cast: DataFrame) -> DataFrame:
    """The lines of ``csv_casts`` that have a reason."""
    return _rejects(cast.filter(F.col("reason").isNotNull()), "csv", F.col("file"), F.col("line_no"),
                    F.col("line"), F.col("reason"))


def json_rejects(docs: DataFrame, source: str, body: str = "body", shape: str = "auto") -> DataFrame:
    """Documents of no known shape, and rows of a known one that are no lists."""
    parsed = json_documents(docs, body, shape)
    whole = _rejects(parsed.filter(F.col("__entries").isNull()), "json", F.col(source), _none(), F.col(body), F.col("__shape"))
    races = parsed.select(F.col(source).alias("__source"), F.explode("__entries").alias("__e"))
    empty = _rejects(races.filter(F.col("__e.v").isNull()), "json", F.col("__source"), _none(), F.col("__e.k"),
                     F.lit("race without rows"))
    rows = races.select("__source", F.posexplode("__e.v").alias("__n", "__row"))
    odd = _rejects(rows.filter(F.col("__row").isNull()), "json", F.col("__source"), F.col("__n"), _none(), F.lit("row is no list"))
    return whole.unionByName(empty).unionByName(odd)


def layout_rejects(rows: DataFrame, layouts: Mapping[int, Sequence[str | None]], source: str, line_no: str,
                   cells: str = "cells") -> DataFrame:
    """Rows whose number of cells no layout has."""
    size = F.coalesce(F.size(F.col(cells)), F.lit(-1))
    odd = rows.filter(~size.isin(*layouts))
    return _rejects(odd, "layout", F.col(source), F.col(line_no), F.to_json(F.col(cells)),
                    F.concat(F.greatest(size, F.lit(0)).cast("string"), F.lit(" cells")))


def text_rejects(docs: DataFrame, source: str, text: str, line_pat: str, header_pat: str | None = None) -> DataFrame:
    """Lines before the header, the header, lines behind it that do not match, and all lines
    of a document without header."""
    lines = numbered_lines(docs, text, header_pat, keep=[source])
    header, n = F.col("__hdr"), F.col("line_no")
    reason = (F.when(header.isNull(), "header not found").when(n < header, "before header").when(n == header, "header")
              .when(~F.col("line").rlike(line_pat), "no match"))
    return _rejects(lines.withColumn("__reason", reason).filter(F.col("__reason").isNotNull()), "text",
                    F.col(source), n, F.col("line"), F.col("__reason"))


def union_rejects(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def balance(kept: Mapping[str, DataFrame], rejects: DataFrame, inputs: Mapping[str, DataFrame]) -> DataFrame:
    """(reader, reason, n_rows, input_rows, complete): rows kept and rejected per reader, against
    its input. ``kept`` and ``inputs`` are one-column counts (n_rows) per reader."""
    counts = [df.select(F.lit(r).alias("reader"), F.lit("kept").alias("reason"), "n_rows") for r, df in kept.items()]
    counts.append(rejects.groupBy("reader", "reason").agg(F.count(F.lit(1)).alias("n_rows")))
    all_ = reduce(DataFrame.unionByName, counts).filter(F.col("n_rows") > 0)
    total = all_.groupBy("reader").agg(F.sum("n_rows").alias("__total"))
    given = reduce(DataFrame.unionByName, [
        df.select(F.lit(r).alias("reader"), F.col("n_rows").alias("input_rows")) for r, df in inputs.items()])
    return all_.join(total, "reader").join(given, "reader").select(
        "reader", "reason", "n_rows", "input_rows", (F.col("__total") == F.col("input_rows")).alias("complete"))
