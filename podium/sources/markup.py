"""HTML tables and fixed-layout text (S7, S8) as column expressions.

No document parser runs on the driver: rows and cells are cut out with
``regexp_extract_all`` and exploded with their positions, one page per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.text import bind, distinct_names

# ---------------------------------------------------------------------------
# Default markup patterns (parameters of html_rows)
# ---------------------------------------------------------------------------
TABLE_ROW = r"(?s)<tr[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"
LIST_ITEM = r"(?s)<li(?:\s[^>]*)?>(.*?)</li>"
TABLE = r"(?is)<table\b[^>]*>(.*?)(?:</table\s*>|$)"
COMMENT = r"(?s)<!--.*?(?:-->|$)"
HEAD = r"(?is)<thead\b[^>]*>(.*?)(?:</thead\s*>|(?=<tbody\b|<tfoot\b)|$)"
FOOT = r"(?is)<tfoot\b[^>]*>.*?(?:</tfoot\s*>|(?=<tbody\b|<thead\b)|$)"
# end tags of rows and cells may be left out: the next row, cell or section ends them
GRID_ROW = r"(?is)<tr\b[^>]*>(.*?)(?=</tr\s*>|<tr\b|</?t(?:head|body|foot)\b|$)"
GRID_CELL = r"(?is)<t[dh]\b[^>]*>.*?(?=</t[dh]\s*>|<t[dh]\b|$)"
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
SPAN_LIMIT = 1000  # columns or rows one cell may span, as in browsers


def html_rows(pages: DataFrame, html: str = "html", row_pat: str = TABLE_ROW,
              cell_pat: str = TABLE_CELL, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., row_no, cells) for every row of every page; cells are trimmed text."""
    rows = pages.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(row_pat), 1))
                        .alias("row_no", "__row"))
    cells = F.transform(F.regexp_extract_all(F.col("__row"), F.lit(cell_pat), 1), lambda c: F.trim(c))
    return rows.select(*keep, "row_no", cells.alias("cells"), F.col("__row").alias("raw"))


def _character(reference) -> Column:
    """The character of a reference's body (``#233``, ``#xE9``, ``eacute``); null if there is none."""
    # a lookup goes through the names in order: the usual ones come first
    known = {**{n: chr(name2codepoint[n]) for n in ("amp", "lt", "gt", "quot", "nbsp")}, "apos": "'",
             **{n: chr(code) for n, code in sorted(name2codepoint.items())}}
    names = F.create_map(*[F.lit(x) for item in known.items() for x in item])
    digits = F.regexp_extract(reference, r"^#([0-9]+)$", 1)
    hexes = F.regexp_extract(reference, r"^#[xX]([0-9a-fA-F]+)$", 1)
    code = F.when(digits != "", digits.try_cast("int")).when(hexes != "", F.conv(hexes, 16, 10).try_cast("int"))
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    point = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
    return F.when(reference.startswith("#"), point).otherwise(F.try_element_at(names, reference))


def decode_references(text) -> Column:
    """Character references in one pass from left to right, so nothing is decoded twice.

    Numeric ones, and the named ones of HTML 4; any other stays as it stands.
    """
    text = F.col(text) if isinstance(text, str) else text
    between = F.split(text, REFERENCE, -1)
    found = F.regexp_extract_all(text, F.lit(REFERENCE), 1)
    joined = F.zip_with(between, found, lambda part, ref: F.concat(
        part, F.coalesce(_character(ref), F.concat(F.lit("&"), ref, F.lit(";")), F.lit(""))))
    return F.when(F.instr(text, "&") == 0, text).otherwise(F.array_join(joined, ""))


def plain_text(cell) -> Column:
    """Text of an HTML fragment: tags gone, references decoded, blanks collapsed."""
    text = decode_references(F.regexp_replace(cell, r"(?s)<[^>]*>", " "))
    return F.trim(F.regexp_replace(text, r"[\s\u00a0]+", " "))


def _cells(row) -> Column:
    """Cells of a row, one entry per column they span: (text, header, rows they span)."""
    def span(raw, name):
        n = F.regexp_extract(raw, rf"""(?is)^<[^>]*?\s{name}\s*=\s*["']?\s*([0-9]{{1,9}})""", 1)
        # led by a 0, as most cells have none and each failed cast costs an exception
        return F.greatest(F.least(F.concat(F.lit("0"), n).cast("int"), F.lit(SPAN_LIMIT)), F.lit(1))

    def cell(raw):
        entry = F.struct(plain_text(F.regexp_replace(raw, r"(?s)^<[^>]*>", "")).alias("text"),
                         F.substring(raw, 3, 1).isin("h", "H").alias("header"), span(raw, "rowspan").alias("rows"))
        return F.array_repeat(entry, span(raw, "colspan"))

    return F.flatten(F.transform(F.regexp_extract_all(row, F.lit(GRID_CELL), 0), cell))


_ENTRY = "struct<text:string,header:boolean,rows:int>"


def _grid_row(above, cells) -> Column:
    """One row of the grid: columns still spanned from above keep their entry, cells take the others in order."""
    n = F.size(above)
    spanned = lambda c: F.coalesce(F.get(above, c)["rows"], F.lit(0)) > 1
    columns = F.sequence(F.lit(0), n + F.size(cells))

    def row(free):
        held = F.coalesce(F.array_max(F.filter(columns, spanned)), F.lit(-1))
        width = F.greatest(F.coalesce(F.array_max(F.slice(free, 1, F.size(cells))), F.lit(-1)), held) + 1

        def entry(column):
            old = F.get(above, column)
            own = F.get(cells, F.array_position(free, column).cast("int") - 1)
            return F.when(old["rows"] > 1, F.struct(old["text"].alias("text"), old["header"].alias("header"),
                                                    (old["rows"] - 1).alias("rows"))).otherwise(own).cast(_ENTRY)

        return F.transform(F.slice(columns, F.lit(1), width), entry)

    return bind(F.filter(columns, lambda c: ~spanned(c)), row)


def grid(rows) -> Column:
    """Rows of a table (their inner HTML) as a grid: every cell stands at each (row, column) it spans.

    A fold over the rows carries what spans down; tables without ``rowspan`` need no fold.
    """
    rows = F.col(rows) if isinstance(rows, str) else rows
    empty = F.array().cast(f"array<{_ENTRY}>")
    start = F.struct(empty.alias("above"), F.array().cast(f"array<array<{_ENTRY}>>").alias("done"))

    def step(state, row):
        return bind(_cells(row).cast(f"array<{_ENTRY}>"), lambda cells: bind(
            _grid_row(state["above"], cells),
            lambda g: F.struct(g.alias("above"), F.array_append(state["done"], g).alias("done"))))

    return bind(rows, lambda all_: (
        F.when(F.exists(all_, lambda r: r.rlike(r"(?is)\srowspan\s*=")), F.aggregate(all_, start, step, lambda s: s["done"]))
        .otherwise(F.transform(all_, lambda r: _cells(r).cast(f"array<{_ENTRY}>")))))


def column_names(header, width) -> Column:
    """Names of ``width`` columns from a table's header rows (a grid): the texts of a column from
    top to bottom, each once, joined by blanks; made distinct by ``distinct_names``."""
    def name(c):
        texts = F.transform(header, lambda r: F.coalesce(F.get(r, c)["text"], F.lit("")))
        return F.array_join(F.array_distinct(F.filter(texts, lambda t: t != "")), " ")

    return distinct_names(F.transform(F.slice(F.sequence(F.lit(0), width), F.lit(1), width), name))


def html_table(pages: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """S7 with named columns: (keep..., table_no, row_no, row) for the body rows of every table of a page.

    Tables are read one by one. Header rows are those of ``thead``, or without one the leading
    rows whose cells are all ``th``; ``tfoot`` is no data. ``row`` maps column names (see
    ``column_names``) to plain text by position in the grid, row headers included; a cell beyond
    the header is named by its column's number. ``row_no`` counts a table's body rows from 0.
    A table inside another one's cell is not told apart from it.

    The work is in the cells, not in the bytes: pages are dealt out over the shuffle partitions, as a
    grouped or small input may come in one. The outer forms of ``explode`` keep the optimizer from
    filtering on what is exploded, which would lay out every grid several times more.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    page = F.regexp_replace(F.col("__html"), COMMENT, "")
    tables = pages.select(*keep, F.col(html).alias("__html")).repartition(parts).select(
        *keep, F.posexplode_outer(F.regexp_extract_all(page, F.lit(TABLE), 1)).alias("table_no", "__table"))
    tables = tables.filter(F.col("__table").isNotNull())
    body = F.regexp_replace(F.regexp_replace(F.col("__table"), HEAD, ""), FOOT, "")
    rows = lambda part: F.regexp_extract_all(part, F.lit(GRID_ROW), 1)
    grids = tables.select(
        *keep, "table_no", grid(rows(F.regexp_extract(F.col("__table"), HEAD, 1))).alias("__head"),
        F.filter(grid(rows(body)), lambda r: F.size(r) > 0).alias("__body"))
    data_row = lambda r: F.exists(r, lambda c: ~F.coalesce(c["header"], F.lit(False)))
    first = F.array_position(F.transform("__body", data_row), F.lit(True)).cast("int")
    leading = F.when(F.size("__head") > 0, F.lit(0)).when(first > 0, first - 1).otherwise(F.size("__body"))
    parts = grids.withColumn("__lead", leading).select(
        *keep, "table_no",
        F.when(F.size("__head") > 0, F.col("__head")).otherwise(F.slice("__body", F.lit(1), F.col("__lead"))).alias("__head"),
        F.slice("__body", F.col("__lead") + 1, F.size("__body")).alias("__body"))
    width = F.array_max(F.transform(F.concat("__head", "__body"), lambda r: F.size(r)))
    named = parts.withColumn("__names", column_names(F.col("__head"), F.coalesce(width, F.lit(0)))).select(
        *keep, "table_no", "__names", F.posexplode_outer("__body").alias("row_no", "__row")).filter(F.col("__row").isNotNull())
    texts = F.transform("__row", lambda c: c["text"])
    return named.select(*keep, "table_no", "row_no", F.map_from_arrays(
        F.slice("__names", F.lit(1), F.size("__row")), texts).alias("row"))


def _line_test(header_pat: str) -> Callable[[Column], Column]:
    """Whether a line has a match of ``header_pat``.

    The regex engine recurses once per turn of a repeated group, so a group repeated without end overflows
    the stack on a long line, which ends the executor. At the end of a pattern the turns beyond the least number
    change no match into a miss, and are left out.
    """
    least = re.sub(r"\)\{(\d+),\}$", r"){\1}", header_pat)
    return lambda line: line.rlike(least)


def without_header(docs: DataFrame, text: str, header_pat: str) -> DataFrame:
    """The documents of which ``text_rows`` yields nothing as no line matches the header."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    return docs.filter(~F.exists(lines, _line_test(header_pat)))


def numbered_lines(docs: DataFrame, text: str, header_pat: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., __hdr, line_no, line): all lines, with the number of their document's header.

    The header is the first line matching ``header_pat`` (null if none does), by default line 0.
    """
    def numbered(lines):
        def entries(header):
            return F.transform(lines, lambda x, i: F.struct(header.alias("__hdr"), i.alias("line_no"), x.alias("line")))

        if header_pat is None:
            return entries(F.lit(0))
        found = F.array_position(F.transform(lines, _line_test(header_pat)), F.lit(True)).cast("int")
        return bind(bind(found, lambda n: F.when(n > 0, n - 1)), entries)

    # the header is bound inside what is exploded: as a column of its own, the optimizer would move its search
    # behind the explode, where it runs through the whole document for each line
    return docs.select(*keep, F.explode(bind(F.split(F.col(text), "\n"), numbered)).alias("__line")).select(*keep, "__line.*")


def text_rows(docs: DataFrame, text: str, line_pat: str, names: Sequence[str],
              header_pat: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Lines after the header that match ``line_pat``, its groups named by ``names``.

    The header is the first line matching ``header_pat`` (default: the first line).
    Lines that do not match are skipped (``rlike`` first: a failed extract gives '').
    All other lines, and those of documents without a header, are in ``rejects.text_rejects``.
    """
    after = numbered_lines(docs, text, header_pat, keep).filter(F.col("line_no") > F.col("__hdr")).drop("__hdr")
    matched = after.filter(F.col("line").rlike(line_pat))
    return matched.select(*keep, "line_no", *[
        F.regexp_extract(F.col("line"), line_pat, i + 1).alias(n) for i, n in enumerate(names)])
