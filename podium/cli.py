"""Command line: score one season from files and write its reports.

    python -m podium.cli --results DIR_OR_FILE --events events.csv --season 25/26 --out OUT
                         [--membership teams.csv | --team-sheet sheet.csv] [--aliases aliases.csv]
                         [--adjustments adj.csv]

Inputs are parquet (a folder or ``*.parquet``) or headed CSV matched by column name:
results (``podium.schema.RESULTS``), events (``EVENTS_DIM``), membership (``MEMBERSHIP``),
aliases (``ALIASES``), adjustments (``ADJUSTMENTS``); or the wide registration sheet
(team name, captain, 2nd..10th member columns) instead of a membership table. Outputs: event-point files per
(season, event, division), individual and team standings, the team scoring report and
age-group winners, as headed CSV under ``--out``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql.types import StringType, StructField, StructType

from podium import schema as S
from podium.operators.team import unpivot_registration
from podium.plans.season_job import run_season, write_season
from podium.session import ensure_checkpoint_dir
from podium.sources.files import read_csv_by_name

OPTIONAL_RESULT_COLS = ("race", "time_s", "overall_place", "location")


def read_table(spark: SparkSession, path: str, schema, optional=()) -> DataFrame:
    if path.endswith(".csv") or path.endswith(".csv/"):
        return read_csv_by_name(spark, path, schema, optional)
    df = spark.read.parquet(path)
    return df.select(*[f.name for f in schema.fields if f.name in df.columns])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="podium")
    ap.add_argument("--results", required=True)
    ap.add_argument("--events", required=True)
    ap.add_argument("--season", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--membership")
    ap.add_argument("--team-sheet")
    ap.add_argument("--aliases")
    ap.add_argument("--adjustments")
    ap.add_argument("--on-violation", choices=("raise", "report"), default="raise")
    args = ap.parse_args(argv)

    # master, memory and partitions come from the caller's session or from spark-submit
    spark = spark or SparkSession.builder.appName("podium-season").getOrCreate()
    ensure_checkpoint_dir(spark)
    results = read_table(spark, args.results, S.RESULTS, OPTIONAL_RESULT_COLS)
    events = read_table(spark, args.events, S.EVENTS_DIM_MODES, ("participation_mode",))
    membership = read_table(spark, args.membership, S.MEMBERSHIP) if args.membership else None
    sheet = None
    if args.team_sheet:
        header = spark.read.option("header", True).csv(args.team_sheet).columns
        sheet = read_csv_by_name(spark, args.team_sheet, StructType([StructField(h, StringType()) for h in header]))
        membership = unpivot_registration(sheet)
    aliases = read_table(spark, args.aliases, S.ALIASES) if args.aliases else None
    adjustments = read_table(spark, args.adjustments, S.ADJUSTMENTS) if args.adjustments else None
    out = run_season(results, events, args.season, membership, aliases, adjustments,
                     on_violation=args.on_violation, registration=sheet)
    write_season(out, args.out, events, args.season)
    return {"events": out.events, "racers": out.standings.count(),
            "repeat_racers": out.repeat_racers.count(), "duplicate_racers": out.duplicate_racers.count(), "violations": out.violations.count()}


if __name__ == "__main__":
    print(main())
