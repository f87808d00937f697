"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.division import age_bracket, age_class_dash, age_class_words, division_from_prefix, division_map
from podium.functions.numbers import clock_seconds, first_int, lenient_int, round_half_up
from podium.functions.text import (capitalize_parts, full_name, split_caps_surname, split_comma_aware,
                                   split_first_last, split_first_rest, split_human)
from podium.operators.agegroup import age_bands, age_group_winners, band_join
from podium.operators.clean import (drop_blank, drop_null, drop_status, patch_rows, tag_race_role,
                                    to_results, union_races)
from podium.operators.event import (consolidate_best, dedupe_entries, field_size, repeat_guard,
                                    score_event)
from podium.operators.place import distributed_rank, place_dense, place_in_division
from podium.operators.quality import alias_report, find_duplicates, guard_partition, reason_counts
from podium.operators.relay import lookup_division, relay_division, relay_stretch
from podium.operators.team import (guard_membership, team_event_points, team_event_rows, team_report,
                                   team_standings, team_top_k, unpivot_membership)
from podium.plans import testbed as tb
from podium.rules import LEGACY
from podium.session import cut_lineage
from podium.sources import rejects
from podium.sources.files import file_layouts, read_lines
from podium.sources.markup import LIST_ITEM, html_rows, html_table, text_rows, without_header
from podium.sources.nested import apply_layouts, json_documents, labelled_rows, read_json_rows, zip_labels
from podium.streaming.incremental import drain, file_stream, run_rescoring_stream, stream_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


POINT_COLS = ["event", "division", "first_name", "last_name", "age", "division_place",
              "race_role", "points"]


@register("event_points")
def q_event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.event_points(spark, sf_dir).select(*POINT_COLS)


def _r4(c):
    return round_half_up(c, 4)


@register("field_size")
def q_field_size(spark, sf_dir):
    return field_size(tb.results(spark, sf_dir))


@register("placement_points")
def q_placement_points(spark, sf_dir):
    pts = tb.event_points(spark, sf_dir, keep_steps=True).filter(F.col("race_role") == "main")
    return pts.select("event", "division", "first_name", "last_name", "division_place", "max_place",
                      _r4("placement").alias("placement"), _r4("floored").alias("floored"))


@register("age_bonus")
def q_age_bonus(spark, sf_dir):
    pts = tb.event_points(spark, sf_dir, keep_steps=True).filter(F.col("race_role") == "main")
    return pts.select("event", "division", "first_name", "last_name", "age", _r4("bonus").alias("bonus"))


@register("participation_points")
def q_participation_points(spark, sf_dir):
    pts = tb.event_points(spark, sf_dir).filter(F.col("race_role") == "participation")
    return pts.select("event", "division", "first_name", "last_name", "points")


RACER = ["division", "first_name", "last_name"]


@register("season_points")
def q_season_points(spark, sf_dir):
    return tb.season(spark, sf_dir, with_adjustments=False).select(*RACER, "n_events", "all_points")


@register("best_six")
def q_best_six(spark, sf_dir):
    return tb.season(spark, sf_dir, with_adjustments=False).select(*RACER, "best_points")


@register("incentives")
def q_incentives(spark, sf_dir):
    return tb.season(spark, sf_dir, with_adjustments=False).select(*RACER, "n_events", "incentive")


@register("adjustments")
def q_adjustments(spark, sf_dir):
    return tb.season(spark, sf_dir).select(*RACER, "adjustment", "series_points")


@register("standings_wide")
def q_standings_wide(spark, sf_dir):
    return tb.standings(spark, sf_dir)


@register("membership_unpivot")
def q_membership_unpivot(spark, sf_dir):
    return tb.membership(spark, sf_dir).select("team_name", "slot", "division", "first_name", "last_name")


@register("membership_guard")
def q_membership_guard(spark, sf_dir):
    reg = tb.registration(spark, sf_dir)
    return guard_membership(reg, unpivot_membership(reg, "team_name", tb.REG_SLOTS))


@register("membership_guard_offenders")
def q_membership_guard_offenders(spark, sf_dir):
    """The guard on forms with offenders of each kind."""
    reg = cut_lineage(tb.flawed_registration(spark, sf_dir), "registration")
    return guard_membership(reg, tb.flawed_membership(reg))


@register("team_join")
def q_team_join(spark, sf_dir):
    rows = team_event_rows(tb.event_points(spark, sf_dir), tb.membership(spark, sf_dir))
    return rows.select("team_name", "event", "division", "first_name", "last_name", "points")


@register("team_top3")
def q_team_top3(spark, sf_dir):
    return team_top_k(tb.team_ranked(spark, sf_dir)).select(
        "team_name", "event", "division", "first_name", "last_name", "team_rank", "points")


@register("team_event_points")
def q_team_event_points(spark, sf_dir):
    return team_event_points(tb.team_ranked(spark, sf_dir))


@register("team_standings")
def q_team_standings(spark, sf_dir):
    return team_standings(team_event_points(tb.team_ranked(spark, sf_dir)), tb.event_years(spark, sf_dir))


@register("team_report")
def q_team_report(spark, sf_dir):
    return team_report(tb.team_ranked(spark, sf_dir))


@register("age_mode")
def q_age_mode(spark, sf_dir):
    return tb.modal_ages(spark, sf_dir).select("division", "name", "age")


@register("band_join")
def q_band_join(spark, sf_dir):
    return band_join(tb.modal_ages(spark, sf_dir), age_bands(spark)).select("division", "name", "age", "age_group")


@register("band_join_many")
def q_band_join_many(spark, sf_dir):
    """A band per order, disjoint: line numbers within the order's band."""
    key = F.col("o_orderkey") * 10
    bands = tb.table(spark, sf_dir, "orders").select("o_orderkey", key.alias("lower"), (key + F.col("o_orderkey") % 10).alias("upper"))
    li = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return band_join(li, bands, "at").select("l_orderkey", "l_linenumber", "o_orderkey")


@register("age_group_winners")
def q_age_group_winners(spark, sf_dir):
    pts = cut_lineage(tb.event_points(spark, sf_dir), "event-points")  # scored once: standings and ages read it
    st = tb.standings(spark, sf_dir, pts)
    return age_group_winners(st, tb.modal_ages(spark, sf_dir, pts), age_bands(spark)).select(
        "division", "age_group", "name", "overall_place")


DAY_COLS = ["event", "division", "first_name", "last_name"]


@register("consolidate_best")
def q_consolidate_best(spark, sf_dir):
    best = consolidate_best(tb.day_points(spark, sf_dir), DAY_COLS)
    return best.select(*DAY_COLS, "race_role", "division_place", "age", "points")


@register("repeat_guard")
def q_repeat_guard(spark, sf_dir):
    return repeat_guard(tb.day_points(spark, sf_dir), DAY_COLS, max_days=2)


@register("unique_guard")
def q_unique_guard(spark, sf_dir):
    return find_duplicates(tb.day_points(spark, sf_dir), DAY_COLS)


@register("dedupe_anti")
def q_dedupe_anti(spark, sf_dir):
    kept = dedupe_entries(tb.entries(spark, sf_dir))
    return kept.select("event", "division", "first_name", "last_name", "entry_id")


@register("place_ordinal")
def q_place_ordinal(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    placed = place_in_division(o, ["o_orderstatus"], [("o_totalprice", "desc"), "o_orderkey"], "place")
    return placed.select("o_orderkey", "o_orderstatus", "place")


@register("place_dense")
def q_place_dense(spark, sf_dir):
    e = tb.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return place_dense(e, ["event_type"], "value", "place").select("event_id", "event_type", "value", "place")


@register("distributed_rank")
def q_distributed_rank(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return distributed_rank(o, [], [("o_totalprice", "desc"), "o_orderkey"], "place").select("o_orderkey", "place")


@register("alias_report")
def q_alias_report(spark, sf_dir):
    return alias_report(tb.event_points(spark, sf_dir), tb.aliases(spark, sf_dir))


@register("lookup_join")
def q_lookup_join(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = tb.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = tb.table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    lookup = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("division"))
    return lookup_division(c, lookup, ["c_nationkey"]).select("c_custkey", "division")


def _relay_teams(spark, sf_dir):
    li = tb.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" &")).alias("name_1"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("name_2"),
        F.when(F.col("l_returnflag") == "A", "Male").when(F.col("l_returnflag") == "N", "Female")
         .otherwise("Mixed").alias("class"),
        F.col("l_extendedprice").alias("time_s"))


def _relay_lookup(spark, sf_dir):
    p = tb.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("name"), F.lit("female").alias("division"))
    s = tb.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("name"), F.lit("male").alias("division"))
    return p.unionByName(s)


@register("relay_stretch")
def q_relay_stretch(spark, sf_dir):
    stretched = relay_stretch(_relay_teams(spark, sf_dir), ["name_1", "name_2"])
    out = relay_division(stretched, "class", _relay_lookup(spark, sf_dir), {"Male": "male", "Female": "female"})
    return out.select("l_orderkey", "l_linenumber", "member_no", "member_name", "class", "division", "time_s")


@register("patch_rows")
def q_patch_rows(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    cond = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return patch_rows(o, cond, "o_orderpriority", "4-NOT SPECIFIED").select("o_orderkey", "o_orderpriority")


MAIN_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@register("race_role")
def q_race_role(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return tag_race_role(o, "o_orderpriority", MAIN_PRIORITIES).select("o_orderkey", "race_role")


@register("union_races")
def q_union_races(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders")
    races = {
        "F": o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice"),
        "O": o.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey"),
        "P": o.filter(F.col("o_orderstatus") == "P").select("o_orderkey", "o_custkey"),
    }
    return union_races(list(races.values()), list(races)).select("race", "o_orderkey", "o_custkey", "o_totalprice")


def _place_text():
    key = F.col("o_orderkey").cast("string")
    return (F.when(F.col("o_orderstatus") == "P", F.lit("DNF"))
            .when(F.col("o_orderstatus") == "F", F.concat(key, F.lit(".")))
            .otherwise(key))


@register("drop_status")
def q_drop_status(spark, sf_dir):
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    o = o.withColumn("place_text", _place_text())
    return drop_status(o, "place_text").select("o_orderkey", first_int("place_text").alias("place"))


@register("clean_rows")
def q_clean_rows(spark, sf_dir):
    e = tb.table(spark, sf_dir, "events")
    raw = to_results(e, {
        "row_id": "event_id",
        "place": lenient_int(F.regexp_extract("props", r":\s*(\d+)", 1)),
        "name": F.when(F.col("event_type") == "error", F.lit("  ")).otherwise(F.col("event_type")),
    })
    return drop_blank(drop_null(raw, ["place"]), ["name"]).select("row_id", "place", "name")


# --- names ---------------------------------------------------------------------

def _caps_text():
    return F.concat(F.col("given"), F.lit(" "), F.upper("p_type"))


@register("name_first_rest")
def q_name_first_rest(spark, sf_dir):
    p = tb.part_text(spark, sf_dir)
    first, last = split_first_rest(_caps_text())
    return p.select("p_partkey", first.alias("first_name"), last.alias("last_name"))


@register("name_first_last")
def q_name_first_last(spark, sf_dir):
    p = tb.part_text(spark, sf_dir)
    first, last = split_first_last(_caps_text())
    return p.select("p_partkey", first.alias("first_name"), last.alias("last_name"))


@register("name_comma")
def q_name_comma(spark, sf_dir):
    p = tb.part_text(spark, sf_dir)
    text = F.when(F.col("p_size") > 25, F.concat(F.upper("p_type"), F.lit(", "), F.col("given"))) \
        .otherwise(F.col("given"))
    first, last = split_comma_aware(text)
    return p.select("p_partkey", first.alias("first_name"), last.alias("last_name"))


@register("name_caps")
def q_name_caps(spark, sf_dir):
    p = tb.part_text(spark, sf_dir)
    text = F.concat(F.col("given"), F.lit(" "),
                    F.when(F.col("p_size") > 40, F.upper("p_brand")).otherwise(F.upper("p_type")))
    first, last, ok = split_caps_surname(text)
    return p.select("p_partkey", first.alias("first_name"), last.alias("last_name"), ok.alias("matched"))


@register("name_human")
def q_name_human(spark, sf_dir):
    p = tb.part_text(spark, sf_dir)
    text = F.concat(F.when(F.col("p_size") > 40, F.lit("Dr. ")).otherwise(F.lit("")), F.col("given"),
                    F.when(F.col("p_size") < 10, F.lit(" Jr.")).otherwise(F.lit("")))
    first, last = split_human(text)
    return p.select("p_partkey", first.alias("first_name"), last.alias("last_name"))


@register("name_human_forms")
def q_name_human_forms(spark, sf_dir):
    """Names with commas, particles, nicknames, titles, suffixes, and of one word."""
    first, last = split_human("text")
    return tb.human_names(spark, sf_dir).select("p_partkey", first.alias("first_name"), last.alias("last_name"))


@register("name_capitalize")
def q_name_capitalize(spark, sf_dir):
    p = tb.part_text(spark, sf_dir)
    text = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" o'"), F.lower("p_type"))
    return p.select("p_partkey", capitalize_parts(text).alias("name"))


@register("full_name")
def q_full_name(spark, sf_dir):
    p = tb.part_text(spark, sf_dir)
    return p.select("p_partkey", full_name("p_brand", "p_type").alias("name"))


# --- parsing -------------------------------------------------------------------

@register("division_norm")
def q_division_norm(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    letter = F.substring("c_mktsegment", 1, 1)
    return c.select("c_custkey",
                    division_from_prefix("c_mktsegment").alias("div_prefix"),
                    division_map(letter, "strict").alias("div_strict"),
                    division_map(letter, "m_else_f").alias("div_m_else_f"),
                    division_map(F.lower(letter), "upper").alias("div_upper"))


@register("age_class")
def q_age_class(spark, sf_dir):
    lab = tb.age_labels(spark, sf_dir)
    d, w = age_class_dash("label"), age_class_words("label")
    d_floor = age_class_dash("label", mid_mode="floor")
    return lab.select("c_custkey", "label", d["age"].alias("dash_age"), d["division"].alias("dash_division"),
                      d_floor["age"].alias("dash_age_floor"),
                      w["age"].alias("words_age"), w["division"].alias("words_division"))


@register("age_bracket")
def q_age_bracket(spark, sf_dir):
    """Brackets with text before and behind them."""
    lab = tb.age_labels(spark, sf_dir)
    text = F.concat(F.lit("Race 9 to 5 of "), F.col("label"), F.lit(" end"))
    return lab.select("c_custkey", age_bracket(text).alias("age"), age_bracket(text, "floor").alias("age_floor"))


@register("quarantine")
def q_quarantine(spark, sf_dir):
    lab = tb.age_labels(spark, sf_dir).withColumn("ac", age_class_dash("label"))
    reasons = {"unreadable_class": lab["ac"].isNull(), "no_division": lab["ac"]["division"].isNull()}
    return reason_counts(lab, reasons)


@register("first_int")
def q_first_int(spark, sf_dir):
    e = tb.table(spark, sf_dir, "events").select("event_id", "props", "user_id")
    label = F.concat(F.lit("Male ("), F.col("user_id").cast("string"), F.lit(")"))
    return e.select("event_id", first_int("props").alias("k"), first_int(label).alias("uid"))


@register("lenient_int")
def q_lenient_int(spark, sf_dir):
    c = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey", lenient_int(F.regexp_extract("c_name", "#(.*)$", 1)).alias("num"),
                    lenient_int("c_mktsegment").alias("seg_num"))


@register("clock_seconds")
def q_clock_seconds(spark, sf_dir):
    e = tb.table(spark, sf_dir, "events").select("event_id", "value")
    t = e.withColumn("t", F.round(F.col("value") * 1000.0, 0).cast("bigint"))
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    h, m = F.expr("t div 360000"), F.expr("(t div 6000) % 60")
    s, f = F.expr("(t div 100) % 60"), F.expr("t % 100")
    clock = F.concat(F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), pad(m)))
                     .otherwise(m.cast("string")), F.lit(":"), pad(s), F.lit("."), pad(f))
    t = t.withColumn("clock", clock)
    return t.select("event_id", "clock", round_half_up(clock_seconds("clock"), 4).alias("seconds"))


# --- sources -------------------------------------------------------------------

@register("json_rows_flat")
def q_json_rows_flat(spark, sf_dir):
    rows = read_json_rows(tb.json_list_pages(spark, sf_dir), "body", "list", keep=["page"])
    named = apply_layouts(rows, {4: ["event_id", "event_type", "value", "user_id"]})
    return named.select("page", F.col("row_no").cast("long").alias("row_no"),
                        F.col("event_id").cast("long").alias("event_id"), "event_type",
                        F.col("value").cast("double").alias("value"), F.col("user_id").cast("long").alias("user_id"))


@register("json_rows_keyed")
def q_json_rows_keyed(spark, sf_dir):
    rows = read_json_rows(tb.json_map_pages(spark, sf_dir), "body", "auto", keep=["page"])
    return rows.select("page", F.col("race_key").alias("race"), F.col("row_no").cast("long").alias("row_no"),
                       F.get("cells", 0).cast("long").alias("event_id"),
                       F.get("cells", 2).cast("double").alias("value"))


@register("ragged_layout")
def q_ragged_layout(spark, sf_dir):
    e = tb.table(spark, sf_dir, "events")
    sid, typ = F.col("event_id").cast("string"), F.col("event_type")
    val, uid = F.col("value").cast("string"), F.col("user_id").cast("string")
    cells = (F.when(typ == "click", F.array(sid, typ, val, uid))
             .when(typ == "view", F.array(sid, typ, uid))
             .when(typ == "purchase", F.array(sid, typ, val, uid, F.col("props")))
             .otherwise(F.array(sid, typ)))
    rows = e.select(cells.alias("cells"))
    named = apply_layouts(rows, {
        5: ["event_id", "event_type", "value", "user_id", "props"],
        4: ["event_id", "event_type", "value", "user_id"],
        3: ["event_id", "event_type", "user_id"],
    })
    return named.select(F.col("event_id").cast("long").alias("event_id"), "event_type",
                        F.col("value").cast("double").alias("value"),
                        F.col("user_id").cast("long").alias("user_id"), "props")


@register("label_zip")
def q_label_zip(spark, sf_dir):
    rows = labelled_rows(tb.json_labelled_pages(spark, sf_dir), "body", keep=["page"])
    z = zip_labels(rows, "labels", offset=2, length=len(tb.LABELS))
    return z.select(F.col("fields")["Bib"].cast("long").alias("event_id"),
                    F.col("fields")["Kind"].alias("kind"),
                    F.col("fields")["Amount"].cast("double").alias("amount"),
                    F.col("fields")["Who"].cast("long").alias("who"))


@register("html_rows")
def q_html_rows(spark, sf_dir):
    pages = tb.table(spark, sf_dir, "pages").select("page_id", "html")
    rows = html_rows(pages, "html", LIST_ITEM, r"(?s)<a[^>]*>(.*?)</a>", keep=["page_id"])
    return rows.select("page_id", F.col("row_no").cast("long").alias("row_no"),
                       F.regexp_extract("raw", r'href="([^"]*)"', 1).alias("href"),
                       F.get("cells", 0).alias("text"))


@register("html_table_rows")
def q_html_table_rows(spark, sf_dir):
    """Pages built from the orders, one table per customer, read back by column name."""
    page, rows = tb.order_pages(spark, sf_dir), F.col("row")
    return html_table(page, "html", keep=["c_custkey"]).select(
        "c_custkey", rows["Order"].cast("long").alias("o_orderkey"), rows["Clerk & co"].alias("o_clerk"),
        rows["Priority"].alias("o_orderpriority"))


@register("html_table_grid")
def q_html_table_grid(spark, sf_dir):
    """Pages of two tables each: spanning cells, row headers and equal header names, read by position."""
    row = F.col("row")
    return html_table(tb.order_grid_pages(spark, sf_dir), "html", keep=["c_custkey"]).select(
        "c_custkey", F.col("table_no").cast("long").alias("table_no"), F.col("row_no").cast("long").alias("row_no"),
        row["Status"].alias("status"), row["Order"].cast("long").alias("o_orderkey"),
        row["Price whole"].cast("long").alias("whole"), row["Price cents"].cast("long").alias("cents"),
        row["N\u00b0"].alias("o_orderpriority"), row["N\u00b0 6"].alias("note"), row["Orders"].cast("long").alias("n_orders"))


@register("text_rows")
def q_text_rows(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = text_rows(docs, "text", r"(?s)^([^ ]+) (.+)", ["word", "rest"], keep=["doc_id"])
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "word", "rest")


HEADER_PAT, LINE_PAT = r"^([^ ]+ ){9,}", r"(?s)^([^ ]+) (.+)"


@register("text_rows_header")
def q_text_rows_header(spark, sf_dir):
    """Lines behind each document's header, the first line of nine words or more."""
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = text_rows(docs, "text", LINE_PAT, ["word", "rest"], HEADER_PAT, keep=["doc_id"])
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "word", "rest")


@register("headerless_documents")
def q_headerless_documents(spark, sf_dir):
    return without_header(tb.table(spark, sf_dir, "documents"), "text", HEADER_PAT).select("doc_id")


@register("label_zip_repeated")
def q_label_zip_repeated(spark, sf_dir):
    rows = labelled_rows(tb.json_labelled_pages(spark, sf_dir, tb.REPEATED_LABELS), "body", keep=["page"])
    fields = F.col("fields")
    return zip_labels(rows, "labels", offset=2).select(
        fields["Bib"].cast("long").alias("event_id"), fields["Kind"].alias("kind"),
        fields["Kind 3"].cast("double").alias("amount"), fields["column 4"].cast("long").alias("who"))


@register("rejects")
def q_rejects(spark, sf_dir):
    """Four readers over input with flaws: rows kept and rejected, by reader and reason."""
    rows = F.count(F.lit(1)).alias("n_rows")
    pages, cells = tb.broken_json_pages(spark, sf_dir), tb.ragged_cells(spark, sf_dir)
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    customer = tb.table(spark, sf_dir, "customer")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    lines = read_lines(spark, tb.customer_csv(spark, sf_dir))
    cast = rejects.csv_casts(lines, cut_lineage(file_layouts(lines, {f.name: f.name for f in schema.fields}), "layouts"), schema)
    layouts = {4: ["event_id", "event_type", "value", "user_id"], 3: ["event_id", "event_type", "user_id"]}
    text_input = docs.select(F.explode(F.split("text", "\n")))
    out = rejects.union_rejects([
        rejects.json_rejects(pages, "page"), rejects.layout_rejects(cells, layouts, "event_id", "event_id"),
        rejects.text_rejects(docs, "doc_id", "text", LINE_PAT, HEADER_PAT), rejects.csv_rejects(cast)])
    kept = {"json": json_documents(pages).filter(F.col("__entries").isNotNull()).agg(rows),
            "layout": apply_layouts(cells, layouts).agg(rows),
            "text": text_rows(docs, "text", LINE_PAT, ["word"], HEADER_PAT).agg(rows),
            "csv": cast.filter(F.col("reason").isNull()).agg(rows)}
    return rejects.balance(kept, out, {"json": pages.agg(rows), "layout": cells.agg(rows),
                                       "text": text_input.agg(rows), "csv": customer.agg(rows)})


# --- streaming -------------------------------------------------------------------

@register("stream_event_points")
def q_stream_event_points(spark, sf_dir):
    """Event points built by the incremental streaming job over the orders files."""
    customer = tb.table(spark, sf_dir, "customer")
    orders_schema = tb.table(spark, sf_dir, "orders").schema
    root = stream_root(spark, "event-points")
    src = file_stream(spark, f"{sf_dir}/orders.parq*", orders_schema)
    q = run_rescoring_stream(src, lambda b: tb.entries_from_orders(b, customer),
                             lambda ent: score_event(tb.results_from_entries(ent)), root)
    drain(q)
    pts = spark.read.parquet(f"{root}/event_points")
    return pts.withColumn("event", F.col("event").cast("long")).select(*POINT_COLS)


@register("completeness")
def q_completeness(spark, sf_dir):
    """Q4: per label style (segment), do the read divisions add up to all rows?"""
    c = tb.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    lab = tb.age_labels(spark, sf_dir).join(c, "c_custkey")
    read = lab.withColumn("division", age_class_dash("label")["division"])
    return guard_partition(read, "division", ["male", "female"], keys=["c_mktsegment"])


@register("age_bonus_legacy")
def q_age_bonus_legacy(spark, sf_dir):
    """E4 with the earlier season's rule (bonus 0.5 per year above 40)."""
    pts = score_event(tb.results(spark, sf_dir), rules=LEGACY, keep_steps=True)
    return pts.filter(F.col("race_role") == "main").select(
        "event", "division", "first_name", "last_name", "age", _r4("bonus").alias("bonus"), "points")


@register("place_from_overall")
def q_place_from_overall(spark, sf_dir):
    """Division place from the sorted overall place, plus the Q4 sum check per race."""
    o = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    overall = cut_lineage(place_in_division(o, ["o_orderpriority"], [("o_totalprice", "desc"), "o_orderkey"], "overall_place"),
                          "overall")  # the one write of the fact: the second place reads it
    placed = place_in_division(overall, ["o_orderpriority", "o_orderstatus"], ["overall_place"], "division_place")
    check = guard_partition(o, "o_orderstatus", ["F", "O", "P"], keys=["o_orderpriority"])
    return placed.join(check.select("o_orderpriority", "complete"), "o_orderpriority").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "overall_place", "division_place", "complete")


@register("season_job_standings")
def q_season_job_standings(spark, sf_dir):
    """The end-to-end season job over the test bed: individual standings."""
    from podium.plans.season_job import run_season
    out = run_season(tb.season_results(spark, sf_dir), tb.season_events_dim(spark, sf_dir), tb.SEASON_KEY, divisions=None,
                     adjustments=tb.adjustments(spark, sf_dir))
    return out.standings.drop("first_name", "last_name")


def _season(spark, sf_dir, **more):
    from podium.plans.season_job import run_season
    return run_season(tb.season_results(spark, sf_dir), tb.season_events_dim(spark, sf_dir), tb.SEASON_KEY, divisions=None,
                      team_divisions=None, adjustments=tb.adjustments(spark, sf_dir), **more)


@register("season_job_teams")
def q_season_job_teams(spark, sf_dir):
    """The season job's team standings."""
    return _season(spark, sf_dir, membership=tb.membership(spark, sf_dir)).team_standings


@register("season_job_report")
def q_season_job_report(spark, sf_dir):
    """The season job's team scoring report."""
    return _season(spark, sf_dir, membership=tb.membership(spark, sf_dir)).team_report


@register("season_job_age_groups")
def q_season_job_age_groups(spark, sf_dir):
    """The season job's age-group winners."""
    return _season(spark, sf_dir).age_group_winners.select("division", "age_group", "name", "overall_place")


@register("season_job_aliases")
def q_season_job_aliases(spark, sf_dir):
    """The season job's alias report."""
    return _season(spark, sf_dir, aliases=tb.aliases(spark, sf_dir)).alias_report


@register("season_job_multiday")
def q_season_job_multiday(spark, sf_dir):
    """Standings of a season of multi-day events: each racer's best row per event counts."""
    from podium.plans.season_job import run_season
    out = run_season(tb.day_results(spark, sf_dir), tb.season_days_dim(spark, sf_dir), tb.SEASON_KEY, divisions=None,
                     adjustments=tb.adjustments(spark, sf_dir))
    return out.standings.drop("first_name", "last_name")


@register("season_job_violations")
def q_season_job_violations(spark, sf_dir):
    """All guards' findings where racers repeat in one-day events and forms have offenders."""
    from podium.plans.season_job import run_season
    reg = cut_lineage(tb.flawed_registration(spark, sf_dir), "registration")
    days = tb.season_events_dim(spark, sf_dir).withColumn("participation_mode", F.lit("none"))
    out = run_season(tb.day_results(spark, sf_dir), days, tb.SEASON_KEY, membership=tb.flawed_membership(reg),
                     registration=reg, divisions=["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"],
                     on_violation="report")
    return out.violations
