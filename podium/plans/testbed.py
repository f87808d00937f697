"""Test bed: the scoring pipeline's inputs, derived from the driver's tables.

Mapping (one row per order joined to its customer):

    event      = year(o_orderdate)           division  = c_mktsegment
    first_name = 'C'                         last_name = c_custkey as text
    age        = null when c_custkey % 11 = 0, else 18 + c_custkey % 60 + year % 3
    race_role  = 'main' when o_orderpriority < '4' else 'participation'
    score      = o_totalprice (higher is better), ties broken by o_orderkey

Main-race rows are reduced to one per (event, customer) by best score and placed
within (event, division); participation rows are deduplicated per name and dropped
when the name ran the main race of the same event. Every frame here grows with the
input tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators.event import (MAIN, PARTICIPATION, dedupe_participation,
                                    score_event)
from podium.operators.place import distributed_rank


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """The events of the test bed in order: all years of the orders (a few calendar years)."""
    year = F.year("o_orderdate").cast("long").alias("y")
    rows = table(spark, sf_dir, "orders").select(year).where("y IS NOT NULL").distinct().orderBy("y").collect()
    return [r.y for r in rows]


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries_from_orders(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def entries_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One race entry per order (see the module docstring for the mapping)."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_mktsegment")
    year = F.year("o_orderdate")
    key = F.col("c_custkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("entry_id"),
        year.cast("long").alias("event"),
        F.col("c_mktsegment").alias("division"),
        F.lit("C").alias("first_name"),
        key.cast("string").alias("last_name"),
        key.alias("racer_key"),
        F.when(key % 11 == 0, F.lit(None))
         .otherwise(F.lit(18) + key % 60 + year % 3).cast("int").alias("age"),
        F.when(F.col("o_orderpriority") < "4", F.lit(MAIN))
         .otherwise(F.lit(PARTICIPATION)).alias("race_role"),
        F.col("o_totalprice").alias("score"),
    )


def main_best(ent: DataFrame) -> DataFrame:
    """Main-race entries, one per (event, racer): best score, then lowest entry id."""
    from podium.operators.place import top_one
    return top_one(ent.filter(F.col("race_role") == MAIN), ["event", "racer_key"],
                   [("score", "desc"), "entry_id"])


RESULT_COLS = ["event", "division", "first_name", "last_name", "racer_key", "age",
               "division_place", "race_role", "entry_id", "score", "max_place"]


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_from_entries(entries(spark, sf_dir))


def results_from_entries(ent: DataFrame) -> DataFrame:
    """Main rows: best entry per (event, racer), placed; participation: one per name without a main row.

    The two reductions are one: of a racer's entries in an event the best main one counts, else the
    participation one of lowest id (a racer of the test bed has one name). So the entries
    are read and shuffled once, and both roles are ranked in one pass; only main rows keep the
    place. Places are 1..n per (event, division, role), so the field size (max place) is the
    group's row count, which the ranking step already knows.
    """
    from podium.operators.place import top_one
    main = F.col("race_role") == MAIN
    one = top_one(ent, ["event", "racer_key"], [main.desc(), F.when(main, F.col("score")).desc_nulls_last(), "entry_id"])
    placed = distributed_rank(one, ["event", "division", "race_role"], [("score", "desc"), "entry_id"],
                              "division_place", group_size="max_place")
    return placed.withColumns({c: F.when(main, F.col(c)) for c in ("division_place", "max_place")}).select(*RESULT_COLS)


def event_points(spark: SparkSession, sf_dir: str, keep_steps: bool = False) -> DataFrame:
    return score_event(results(spark, sf_dir), keep_steps=keep_steps)


# ---------------------------------------------------------------------------
# Season, teams, age groups
# ---------------------------------------------------------------------------

def adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual adjustments: -10 for every customer with a negative account balance."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    return c.select(F.lit("C").alias("first_name"), F.col("c_custkey").cast("string").alias("last_name"),
                    F.lit(-10.0).alias("bias_adjustment"))


def season(spark: SparkSession, sf_dir: str, points: DataFrame | None = None,
           with_adjustments: bool = True) -> DataFrame:
    from podium.operators.season import apply_adjustments, season_points
    pts = points if points is not None else event_points(spark, sf_dir)
    s = season_points(pts, events=event_years(spark, sf_dir))
    return apply_adjustments(s, adjustments(spark, sf_dir)) if with_adjustments else s


def standings(spark: SparkSession, sf_dir: str, points: DataFrame | None = None) -> DataFrame:
    from podium.operators.season import standings_wide
    return standings_wide(season(spark, sf_dir, points), event_years(spark, sf_dir))


def registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide team forms: customers of a nation in key order, ten per form.

    Form ``<nation> #<n>`` holds the nation's customers 10(n-1)+1 .. 10n; each slot has
    a name cell ('C <custkey>') and a division cell (the market segment).
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    members = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # 25 nations: fixed size
    numbered = distributed_rank(members, ["c_nationkey"], ["c_custkey"], "rn")
    form = F.floor((F.col("rn") - 1) / 10).cast("long") + 1
    slot = ((F.col("rn") - 1) % 10 + 1).cast("int")
    long = numbered.select(
        F.concat(F.col("n_name"), F.lit(" #"), form.cast("string")).alias("team_name"), slot.alias("slot"),
        F.concat(F.lit("C "), F.col("c_custkey").cast("string")).alias("name"),
        F.col("c_mktsegment").alias("division"))
    cells = []
    for i in range(1, 11):  # unused slots of a nation's last form say "na", as on paper forms
        for field, col in (("name", "name"), ("division", "division")):
            cells.append(F.coalesce(F.max(F.when(F.col("slot") == i, F.col(col))), F.lit("na"))
                         .alias(f"member_{i}_{field}"))
    return long.groupBy("team_name").agg(*cells)


REG_SLOTS = [(f"member_{i}_name", f"member_{i}_division") for i in range(1, 11)]


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, html): the orders of each customer as an HTML result table with markup."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    row = F.concat(F.lit('<tr class="r"><td><a href="/o">'), F.col("o_orderkey").cast("string"),
                   F.lit("</a></td>\n<td>Clerk &amp; <b>"), F.col("o_custkey").cast("string"),
                   F.lit("</b> &lt;x&gt;</td><td>"), F.col("o_orderpriority"), F.lit("</td></tr>"))
    head = "<table><thead><tr><th>Order</th><th scope='col'>Clerk &amp; co</th><th>Priority</th></tr></thead>"
    return (o.select(F.col("o_custkey").alias("c_custkey"), row.alias("row"))
            .groupBy("c_custkey").agg(F.array_join(F.collect_list("row"), "").alias("rows"))
            .select("c_custkey", F.concat(F.lit(head), F.col("rows"), F.lit("</table>")).alias("html")))


def order_grid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, html): per customer a page of two tables with spanning cells, row headers,
    a repeated header, numeric references, cells without end tags and no ``thead`` in the second.

    The first lists the orders by status, whose cell spans its rows; the second counts them.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    text = lambda c: c.cast("string")
    cells = F.concat(F.lit('<th scope="row">'), text(F.col("o_orderkey")), F.lit("</th><td>"),
                     text(F.floor("o_totalprice").cast("long")), F.lit("<td align=right>"), text(F.col("o_orderkey") % 100),
                     F.lit("</td><td>"), F.col("o_orderpriority"), F.lit("</td>\n<td>caf&eacute; &#x26;amp; &amp;#233;</td></tr>"))
    row = F.struct("o_orderkey", cells.alias("cells"))
    status = (o.groupBy("o_custkey", "o_orderstatus").agg(F.array_sort(F.collect_list(row)).alias("rows"))
              .withColumn("n", F.size("rows")))
    first = F.concat(F.lit('<tr><td rowspan="'), text(F.col("n")), F.lit('">'), F.col("o_orderstatus"), F.lit("</td>"))
    status = status.select("o_custkey", "o_orderstatus", F.array_join(F.transform("rows", lambda r, i: F.concat(
        F.when(i == 0, first).otherwise(F.lit("<tr>")), r["cells"])), "").alias("rows"), F.concat(
        F.lit("<tr><td>"), F.col("o_orderstatus"), F.lit("<td>"), text(F.col("n")), F.lit("</tr>")).alias("count"))
    page = status.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderstatus", "rows", "count"))).alias("s"))
    joined = lambda field: F.array_join(F.transform("s", lambda x: x[field]), "")
    head = ('<table class="a"><!-- <tr><td>old</td></tr> --><thead><tr><th rowspan="2">Status</th>'
            "<th rowspan=2 scope=col>Order</th><th colspan='2'>Price</th><th rowspan='2'>N&#176;</th><th rowspan='2'>"
            "N&#xB0;</th></tr><tr><th>whole</th><th>cents</th></tr></thead><tbody>")
    return page.select(F.col("o_custkey").alias("c_custkey"), F.concat(
        F.lit(head), joined("rows"), F.lit("</tbody><tfoot><tr><td>end</td></tr></tfoot></table><p>and</p><TABLE><tr>"
                                           "<th>Status<th>Orders</tr>"), joined("count"), F.lit("</TABLE>")).alias("html"))


def human_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, a, b, kind, text): full names in the forms that result lists use, by part key."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.initcap("p_name").alias("n"))
    p = p.select("p_partkey", F.split_part("n", F.lit(" "), F.lit(1)).alias("a"),
                 F.split_part("n", F.lit(" "), F.lit(2)).alias("b"), (F.col("p_partkey") % 8).alias("kind"))
    a, b, kind = F.col("a"), F.col("b"), F.col("kind")
    forms = [F.concat(b, F.lit(", "), a, F.lit(" X.")), F.concat(a, F.lit(" Q. de la "), b, F.lit(" III")), a,
             F.concat(F.lit("Dr. "), a), F.concat(a, F.lit(' (Bob) "Bo"  '), b, F.lit(", PhD")), F.concat(F.lit("van "), a, F.lit(" "), b),
             F.concat(F.lit("von "), b, F.lit(", Mr. "), a, F.lit(", Jr.")), F.lit("  ")]
    text = F.coalesce(*[F.when(kind == i, f) for i, f in enumerate(forms)])
    return p.withColumn("text", text)


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.operators.team import unpivot_membership
    return unpivot_membership(registration(spark, sf_dir), "team_name", REG_SLOTS)


def team_ranked(spark: SparkSession, sf_dir: str, points: DataFrame | None = None) -> DataFrame:
    from podium.operators.team import team_event_rows, team_ranked as rank
    pts = points if points is not None else event_points(spark, sf_dir)
    return rank(team_event_rows(pts, membership(spark, sf_dir)))


def modal_ages(spark: SparkSession, sf_dir: str, points: DataFrame | None = None) -> DataFrame:
    from podium.operators.agegroup import collect_ages, modal_age
    pts = points if points is not None else event_points(spark, sf_dir)
    return modal_age(collect_ages(pts))


def day_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order scored as one race day: all main entries placed, no reduction.

    Input of the multi-day consolidation (E8) and the repeat / uniqueness guards.
    """
    ent = entries(spark, sf_dir)
    main = distributed_rank(ent.filter(F.col("race_role") == MAIN), ["event", "division"],
                            [("score", "desc"), "entry_id"], "division_place", group_size="max_place")
    part = (ent.filter(F.col("race_role") == PARTICIPATION)
            .withColumns({"division_place": F.lit(None).cast("long"), "max_place": F.lit(None).cast("long")}))
    return score_event(main.select(*RESULT_COLS).unionByName(part.select(*RESULT_COLS)))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known aliases: racer 'C <k>' is also known as supplier k ('S', s_name)."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.lit("C").alias("alias_fn"), F.col("s_suppkey").cast("string").alias("alias_ln"),
                    F.lit("S").alias("actual_fn"), F.col("s_name").alias("actual_ln"))


# ---------------------------------------------------------------------------
# Raw documents (fetched result pages) built from the driver tables
# ---------------------------------------------------------------------------
PAGE_ROWS = 50  # rows per fetched result page (the HTML source's page size)


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id", "props")
    return e.select(
        F.expr(f"event_id div {PAGE_ROWS}").alias("page"), "event_id", "event_type",
        F.array(F.col("event_id").cast("string"), F.col("event_type"), F.col("value").cast("string"),
                F.col("user_id").cast("string")).alias("cells"))


def _sorted_rows(col_id: str = "event_id", cells: str = "cells"):
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(col_id), F.col(cells)))),
                       lambda x: x[cells])


def json_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per page: ``{"data": [[cells], ...]}`` (50 rows at most)."""
    return (event_cells(spark, sf_dir).groupBy("page")
            .agg(F.to_json(F.struct(_sorted_rows().alias("data"))).alias("body")))


def json_map_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per page, rows keyed by race: ``{"data": {type: [[cells]]}}``."""
    per_race = (event_cells(spark, sf_dir).groupBy("page", "event_type")
                .agg(_sorted_rows().alias("rows")))
    return (per_race.groupBy("page")
            .agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("event_type", "rows")))
                                    .alias("data"))).alias("body")))


LABELS = ("Bib", "Kind", "Amount", "Who")


def json_labelled_pages(spark: SparkSession, sf_dir: str, labels=LABELS) -> DataFrame:
    """Pages with a heading list and a result set; cell 1 is a row tag without label."""
    cells = event_cells(spark, sf_dir).withColumn(
        "cells", F.concat(F.array(F.concat(F.lit("r"), F.col("event_id").cast("string"))), F.col("cells")))
    headings = F.array(*[F.struct(F.lit(h).alias("key")) for h in labels])
    return (cells.groupBy("page")
            .agg(F.to_json(F.struct(headings.alias("headings"),
                                    F.struct(_sorted_rows().alias("results")).alias("resultSet")))
                 .alias("body")))


REPEATED_LABELS = ("Bib", "Kind", "Kind", " ")


def broken_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list pages, some of them cut off, without data, or with data of no known shape."""
    kind = F.col("page") % 7
    return json_list_pages(spark, sf_dir).withColumn(
        "body", F.when(kind == 1, F.expr("substring(body, 1, length(body) - 3)")).when(kind == 2, '{"rows": []}')
        .when(kind == 3, '{"data": 7}').otherwise(F.col("body")))


def ragged_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, cells): events as rows of two to five cells, by their type."""
    e = table(spark, sf_dir, "events")
    sid, typ = F.col("event_id").cast("string"), F.col("event_type")
    val, uid = F.col("value").cast("string"), F.col("user_id").cast("string")
    return e.select("event_id", (
        F.when(typ == "click", F.array(sid, typ, val, uid)).when(typ == "view", F.array(sid, typ, uid))
        .when(typ == "purchase", F.array(sid, typ, val, uid, F.col("props"))).otherwise(F.array(sid, typ))).alias("cells"))


def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    """Folder of headed CSV files of the customers, with texts where a number belongs and empty cells."""
    from podium.session import shared_path
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    key = F.col("c_custkey")
    path = shared_path(spark, "customer-csv")
    c.select(F.when(key % 11 == 0, F.lit("first, or last")).otherwise(key.cast("string")).alias(" C_CustKey"), "c_name",
             F.when(key % 9 == 0, F.lit("n/a")).when(key % 9 != 1, F.col("c_acctbal").cast("string")).alias("c_acctbal"),
             "c_mktsegment").write.option("header", True).csv(path)
    return path


def part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    return p.withColumn("given", F.initcap("p_name"))


def age_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age-class label per customer, in one of the published label styles (by segment)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    letter = F.when(F.col("c_nationkey") < 12, F.lit("M")).otherwise(F.lit("F"))
    lo = F.lit(18) + F.col("c_custkey") % 60
    s = lambda x: x.cast("string")
    label = (F.when(F.col("c_mktsegment") == "AUTOMOBILE",
                    F.concat(letter, s(lo), F.lit("-"), s(lo + 5), F.lit(" ("), s(F.col("c_nationkey")), F.lit(")")))
             .when(F.col("c_mktsegment") == "BUILDING",
                   F.concat(letter, F.lit(" "), s(lo), F.lit(" to "), s(lo + 4), F.lit(" (2)")))
             .when(F.col("c_mktsegment") == "FURNITURE",
                   F.concat(F.when(letter == "M", F.lit("Male")).otherwise(F.lit("Female")),
                            F.lit(" ("), s(F.col("c_nationkey")), F.lit(")")))
             .when(F.col("c_mktsegment") == "HOUSEHOLD",
                   F.when(letter == "M", F.concat(letter, s(lo), F.lit("+")))
                    .otherwise(F.concat(letter, F.lit("  "), s(lo))))
             .otherwise(F.concat(letter, s(lo - 6), F.lit("-"), s(lo - 4))))
    return c.select("c_custkey", label.alias("label"))


# ---------------------------------------------------------------------------
# The season job's own inputs (long results table + events table)
# ---------------------------------------------------------------------------
SEASON_KEY = "tb"


def season_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test bed as a ``RESULTS`` table: placed main rows, raw participation rows."""
    from podium.schema import RESULTS
    ent = entries(spark, sf_dir)
    placed = distributed_rank(main_best(ent), ["event", "division"],
                              [("score", "desc"), "entry_id"], "division_place")
    part = (ent.filter(F.col("race_role") == PARTICIPATION)
            .withColumn("division_place", F.lit(None).cast("long")))
    cols = {
        "season": F.lit(SEASON_KEY), "event": F.col("event").cast("string"), "race": F.col("race_role"),
        "race_role": F.col("race_role"), "division": F.col("division"), "first_name": F.col("first_name"),
        "last_name": F.col("last_name"), "age": F.col("age").cast("int"), "time_s": F.lit(None).cast("double"),
        "overall_place": F.lit(None).cast("long"), "division_place": F.col("division_place").cast("long"),
        "location": F.lit(None).cast("string"),
    }
    pick = [cols[f.name].alias(f.name) for f in RESULTS.fields]
    return placed.select(*pick).unionByName(part.select(*pick))


def season_events_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-day event per order year (a dimension: distinct years of the orders)."""
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    return (o.select(year.alias("y")).distinct()
            .select(F.lit(SEASON_KEY).alias("season"), F.col("y").cast("string").alias("event"),
                    F.concat(F.lit("Year "), F.col("y").cast("string")).alias("human_name"),
                    F.lit(1).alias("event_days"), F.col("y").cast("int").alias("seq"),
                    F.lit("dedupe").alias("participation_mode")))


def day_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``season_results``, but every main entry is a row: events of many days, racers repeat."""
    from podium.schema import RESULTS
    ent = entries(spark, sf_dir)
    main = distributed_rank(ent.filter(F.col("race_role") == MAIN), ["event", "division"],
                            [("score", "desc"), "entry_id"], "division_place")
    part = ent.filter(F.col("race_role") == PARTICIPATION).withColumn("division_place", F.lit(None).cast("long"))
    own = {"season": F.lit(SEASON_KEY), "event": F.col("event").cast("string"), "race": F.col("race_role")}
    pick = [(own[f.name] if f.name in own else F.col(f.name) if f.name in part.columns else F.lit(None))
            .cast(f.dataType).alias(f.name) for f in RESULTS.fields]
    return main.select(*pick).unionByName(part.select(*pick))


def season_days_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of ``day_results``: as many days as any racer has entries, all rows consolidated."""
    return season_events_dim(spark, sf_dir).withColumns(
        {"event_days": F.lit(1_000_000), "participation_mode": F.lit("consolidate")})


def flawed_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The team forms with offenders of each kind: every first form of a nation comes twice, every
    second one again under another team name with a one-word name in its first slot."""
    reg = registration(spark, sf_dir)
    again = reg.filter(F.col("team_name").endswith("#1"))
    other = reg.filter(F.col("team_name").endswith("#2")).withColumns(
        {"team_name": F.concat("team_name", F.lit(" B")), "member_1_name": F.lit("Solo")})
    return reg.unionByName(again).unionByName(other)


def flawed_membership(reg: DataFrame) -> DataFrame:
    """Members of ``flawed_registration``; one market segment cannot be read as a division."""
    from podium.operators.team import unpivot_membership
    return unpivot_membership(reg, "team_name", REG_SLOTS,
                              division_of=lambda c: F.when(F.trim(c) != "MACHINERY", F.trim(c)))
