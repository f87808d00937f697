"""Headed CSV in and out.

Hand-over tables are one long table partitioned by season, event and division
(``season=../event=../division=..`` folders), so a missing (event, division) is
simply an absent partition, and readers prune to what they need.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.operators.joins import null_safe_join
from podium.rules import REPORT_SENTINEL
from podium.schema import EVENT_POINTS, EVENT_POINTS_FILE
from podium.session import cut_lineage

PARTITIONS = ("season", "event", "division")


def read_csv_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   header: bool = True) -> DataFrame:
    """Headed CSV with a fixed schema (never inferred); bad cells become null."""
    return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
            .option("enforceSchema", True).csv(path))


def read_csv_by_name(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                     optional: Sequence[str] = ()) -> DataFrame:
    """S1 + P5: headed CSV matched to ``schema`` by header name (trimmed, any case).

    Cells are read as text and cast with ``try_cast`` (bad cells become null).
    Missing required headers raise with the full list; ``optional`` columns that
    are absent come back as nulls.
    """
    from podium.operators.clean import resolve_columns
    raw = spark.read.option("header", True).csv(path)
    present = {c.strip().lower() for c in raw.columns}
    wanted = {f.name: f.name for f in schema.fields
              if f.name not in optional or f.name.lower() in present}
    resolved = resolve_columns(raw, wanted)
    return resolved.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in wanted else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def read_lines(spark: SparkSession, root: str, partitions: Sequence[str] = ()) -> DataFrame:
    """(partitions..., file, block_start, line_id, line): the text lines of all files below ``root``.

    ``partitions`` are the folder keys, read as text and unescaped; the planner prunes folders by
    filters on them. ``line_id`` rises with the lines of a file's block, ``block_start`` is the
    block's first byte. No line is read on the driver, and the number of jobs is fixed.
    """
    schema = T.StructType([T.StructField("line", T.StringType())] + [T.StructField(p, T.StringType()) for p in partitions])
    return spark.read.schema(schema).text(root).select(
        *partitions, F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"), "line")


def csv_cells(line) -> Column:
    """Cells of a CSV line: quoted cells may hold commas and escaped or doubled quotes; an empty cell is null."""
    line = F.regexp_replace(F.col(line) if isinstance(line, str) else line, r"^\uFEFF|\r$", "")
    quoted = r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"(?=,|$)'
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(rf"(?s),({quoted}|[^,]*)"), 1)

    def cell(c):
        inner = F.substring(c, F.lit(2), F.length(c) - 2)
        text = F.replace(F.replace(inner, F.lit('""'), F.lit('"')), F.lit('\\"'), F.lit('"'))
        return F.when(c.rlike(rf"(?s)^{quoted}$"), text).when(c != "", c)

    return F.transform(raw, cell)


def file_layouts(lines: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """(file, head_id, header, columns): each file's header as data, one row per file.

    The header is the line of lowest number in the block that starts at byte 0 (one partial
    aggregate over the lines). ``columns`` gives the position of each canonical name of
    ``names`` whose header text (trimmed, any case) the file has; of equal headers the last counts.
    """
    first = (lines.filter(F.col("block_start") == 0).groupBy("file")
             .agg(F.min_by("line", "line_id").alias("line"), F.min("line_id").alias("head_id")))
    header = F.transform(csv_cells("line"), lambda c: F.lower(F.trim(c)))
    first = first.select("file", "head_id", header.alias("header"))
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(h.strip().lower()).alias("text")) for k, h in names.items()])
    last = lambda text: F.size("header") - F.coalesce(F.array_position(F.reverse("header"), text), F.lit(0)).cast("int")
    columns = F.transform(wanted, lambda w: F.struct(w["name"].alias("name"), last(w["text"]).alias("position")))
    return first.withColumn("columns", F.filter(columns, lambda c: c["position"] < F.size("header")))


def bind_by_header(lines: DataFrame, layouts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., file, line_id, cells): the data lines' cells by canonical column name.

    Each line meets its file's layout by a join on the file, so files of different layouts can
    lie in one folder; the planner broadcasts the layouts (one row per file) only if their
    table is small. ``cells`` maps the names that the file has; blank lines are no data.
    """
    data = lines.filter(F.trim("line") != "").join(layouts.select("file", "head_id", "columns"), "file").filter(
        (F.col("block_start") != 0) | (F.col("line_id") != F.col("head_id")))
    named = data.withColumn("__cells", csv_cells("line"))
    return named.select(*keep, "file", "line_id", F.map_from_arrays(
        F.transform("columns", lambda c: c["name"]),
        F.transform("columns", lambda c: F.get("__cells", c["position"]))).alias("cells"))


def load_event_points(spark: SparkSession, root: str, season: str | None = None,
                      with_location: bool = False) -> DataFrame:
    """All event-point files of a season as one long table.

    Partition columns come from the folder names, unescaped; an absent (event, division) contributes
    no rows. Columns are bound by each file's own header, in any order; ``location`` is optional
    and returned if asked for. A file without a required column raises. The sentinel stands for no place (a
    participation row) and, independently, for no age. Returns an empty frame with the schema
    if nothing exists. The number of jobs does not depend on the number of folders or layouts.
    """
    names = {f.name: f.dataType for f in EVENT_POINTS_FILE.fields} | {"location": T.StringType()}
    if not _exists(spark, root):
        empty = spark.createDataFrame([], EVENT_POINTS)
        return empty.withColumn("location", F.lit(None).cast("string")) if with_location else empty
    lines = read_lines(spark, root, PARTITIONS)
    if season is not None:
        lines = lines.filter(F.col("season") == season)
    layouts = cut_lineage(file_layouts(lines, {c: c for c in names}), "layouts")
    required = F.array(*[F.lit(c) for c in names if c != "location"])
    missing = F.array_except(required, F.transform("columns", lambda c: c["name"]))
    bad = layouts.select("file", missing.alias("missing")).filter(F.size("missing") > 0).orderBy("file").take(3)
    if bad:
        raise ValueError(f"event-point files without required columns: {[(r.file, r.missing) for r in bad]}")
    bound = bind_by_header(lines, layouts, keep=PARTITIONS)
    df = bound.select(*PARTITIONS, *[F.try_element_at("cells", F.lit(c)).try_cast(t).alias(c) for c, t in names.items()])
    sentinel = F.lit(REPORT_SENTINEL)
    is_part = F.col("gender_place") == sentinel
    cols = [
        "season", "event", "division", "first_name", "last_name",
        F.when(F.col("age") == sentinel, F.lit(None).cast("int")).otherwise(F.col("age")).alias("age"),
        F.when(is_part, F.lit(None).cast("long")).otherwise(F.col("gender_place")).alias("division_place"),
        F.when(is_part, F.lit("participation")).otherwise(F.lit("main")).alias("race_role"),
        F.col("age_advantage_event_points").alias("points")]
    return df.select(*cols, *(["location"] if with_location else []))


def _exists(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` holds any season folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(top.suffix("/season=*/event=*/division=*")))


def write_event_points(points: DataFrame, root: str, with_location: bool = False,
                       mode: str = "overwrite") -> None:
    """One CSV folder per (season, event, division), rows by points descending.

    Participation rows show the report sentinel as place and age. Rows are range
    partitioned on the partition keys and points, so each folder is written by a
    few tasks in order; no single-partition ``coalesce``. Other seasons below ``root`` are
    left alone; folders of the written seasons that have no rows any more are removed.
    """
    sentinel = F.lit(REPORT_SENTINEL)
    is_part = F.col("race_role") == "participation"
    cols = [
        F.when(is_part, sentinel.cast("long")).otherwise(F.col("division_place")).alias("gender_place"),
        "first_name", "last_name",
        F.when(is_part, sentinel).otherwise(F.col("age")).alias("age"),
        F.col("points").alias("age_advantage_event_points"),
    ]
    if with_location:
        cols.append("location")
    out = points.select(*PARTITIONS, *cols)
    order = [*PARTITIONS, F.col("age_advantage_event_points").desc()]
    (out.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS).option("header", True).csv(root))
    if mode == "overwrite":
        _remove_stale(out, root)


def _remove_stale(out: DataFrame, root: str) -> None:
    """Remove the folders of the seasons of ``out`` whose event and division it lacks.

    Spark lists the folders, so their keys are unescaped and the default folder is a null key, as
    in ``out``; both sides meet by null-safe joins and only folders to remove reach the driver.
    An empty key is written as the default folder too.
    """
    spark = out.sparkSession
    if not _exists(spark, root):
        return
    kept = out.select(*[F.when(F.col(p).cast("string") != "", F.col(p).cast("string")).alias(p) for p in PARTITIONS]).distinct()
    kept = cut_lineage(kept, "written-keys")
    there = read_lines(spark, root, PARTITIONS).groupBy(*PARTITIONS).agg(F.collect_set(
        F.regexp_replace("file", "/[^/]*$", "")).alias("folders"))
    there = null_safe_join(there, kept.select("season").distinct(), ["season"], "left_semi")
    stale = null_safe_join(there, kept, list(PARTITIONS), "left_anti").select(F.explode("folders").alias("folder"))
    jvm = spark.sparkContext._jvm
    for r in stale.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r.folder))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_report(df: DataFrame, path: str, display: Mapping[str, str] | None = None,
                 order: Sequence | None = None, mode: str = "overwrite") -> None:
    """Standings and reports as headed CSV with display column names."""
    out = df.select(*[F.col(c).alias((display or {}).get(c, c)) for c in df.columns])
    if order:
        out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    out.write.mode(mode).option("header", True).csv(path)
