"""Benchmark decontamination by template windows, in native expressions only.

Numbers, their units and names become typed placeholders, other tokens lose case and punctuation,
so a question with new numbers or names keeps its template. Every ``WINDOW`` tokens of a
document are hashed and joined with those of the benchmark items. A hit counts if the
templates are equal; the slots of all hits of one alignment must then map each benchmark
value to one document value. A document leaks an item when the alignments with consistent
slots of one place cover as many item tokens as a single run over ``MIN_SHARE`` of the item's
windows has, or ``MIN_TOKENS`` of a long item. Inserted and deleted words split a copy into
alignments; those less than the item's length apart belong to one place. ``windows``, ``slots``
and ``exact`` are those of single alignments that suffice, else those of the whole place.

A template window needs half of its tokens to be literal. The same windows are also joined as
plain tokens, without case: a lower-cased or ALL-CAPS copy turns names into words, but its words
stay. An item without a template window is looked for by its plain windows alone, one of ``SHORTEST``
tokens up to ``WINDOW`` by a single window of its own length. Benchmark windows are broadcast up to
``BROADCAST_ROWS`` rows, counted first; beyond that the hashes are joined by a shuffle.

Defined cases: a null or empty text has no window; an item of fewer than ``SHORTEST`` tokens, an
everyday phrase, is not looked for; repeated benchmark rows count once;
documents that share a doc_id (or have none) are judged together; empty tables give no
rows; other columns are ignored; private-use characters E001 to E003 read as placeholders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import written

WINDOW = 8
MIN_SHARE = 0.3
MIN_TOKENS = 50
SHORTEST = 5
BROADCAST_ROWS = 1_000_000
NUMBER, UNIT, NAME = "\ue001", "\ue002", "\ue003"
UNITS = ("km", "cm", "mm", "mi", "ft", "kg", "mg", "lb", "lbs", "oz", "ml", "mph", "kph", "kmh", "hz",
         "kw", "kwh", "usd", "eur", "gbp", "percent", "meter", "meters", "metre", "metres",
         "kilometer", "kilometers", "mile", "miles", "foot", "feet", "inch", "inches", "gram",
         "grams", "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces", "liter", "liters",
         "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days",
         "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent", "cents",
         "euro", "euros", "degree", "degrees")
S, W = r"\x20\x09-\x0D", r"[^\x20\x09-\x0D]"
PUNCTUATION = (r"[!-/:-@\[-`{-~\x{A1}-\x{BF}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{3001}-\x{3003}"
               r"\x{3008}-\x{3011}]+")


def template_tokens(text: Column) -> Column:
    """Canonical tokens: placeholders, or lower-case words without punctuation.

    From its first digit on a token is a number, a unit word after a number is a unit, and a
    token that starts with an upper-case and a lower-case letter is a name.
    """
    text = F.regexp_replace(text, PUNCTUATION, "")
    text = F.regexp_replace(text, rf"[0-9]{W}*+", NUMBER)
    text = F.regexp_replace(text, rf"({NUMBER}[{S}]+)(?i:{'|'.join(UNITS)})(?=[{S}]|$)", f"$1{UNIT}")
    text = F.regexp_replace(text, rf"(^|[{S}])\p{{Lu}}\p{{Ll}}{W}*+", f"$1{NAME}")
    return _tokens(F.lower(text))


def plain_tokens(text: Column) -> Column:
    """The tokens of a text, one for each canonical token, without punctuation."""
    return _tokens(F.lower(F.regexp_replace(text, PUNCTUATION, "")))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"{W}+"), F.lit(0))


def with_window_keys(frame: DataFrame, tokens: str, window: int = WINDOW) -> DataFrame:
    """Adds ``keys``: the hash of the ``window`` tokens from each position on.

    Hashes of 1, 2, 4, ... tokens are paired with those as many positions on, the last ones with
    those that end the window. Each step is a
    column of its own, as an expression used twice would be evaluated twice. The last keys
    are hashes of fewer tokens, which equal no hash of a whole window.
    """
    kept = frame.columns
    frame, width = frame.withColumn("keys", F.transform(tokens, lambda t: F.xxhash64(t))), 1
    while width < window:
        step = min(width, window - width)
        later = F.slice("keys", F.lit(step + 1), F.size("keys"))
        frame = frame.select(*kept, F.zip_with("keys", later, lambda a, b: F.xxhash64(a, b)).alias("keys"))
        width += step
    return frame


def _is_slot(token: Column) -> Column:
    return token.isin(UNIT, NAME) | token.endswith(NUMBER)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, part, width, at, template, plain, item_windows, item_tokens), a row per window.

    ``part`` is 0 for template windows, and a hash of the text for those of a text without one.
    """
    items = (benchmark.select("item_id", F.col("text").alias("text")).where("text IS NOT NULL").distinct()
             .select("item_id", F.xxhash64("text").alias("text_key"),
                     template_tokens(F.col("text")).alias("tokens"), plain_tokens(F.col("text")).alias("plain"))
             .withColumn("length", F.size("tokens")).where(F.col("length") >= min(SHORTEST, window)))
    width = F.least("length", F.lit(window))
    items = items.withColumn("width", width).withColumn("every", F.expr("sequence(1, length - width + 1)"))
    literal = F.filter("every", lambda at: F.size(F.filter(
        F.slice("tokens", at, F.col("width")), _is_slot)) * 2 <= F.col("width"))
    none = F.array().cast("array<int>")
    items = items.withColumn("literal", F.when(F.col("length") >= window, literal).otherwise(none))
    found = F.size("literal") > 0
    rows = items.select("item_id", F.when(found, F.lit(0).cast("long")).otherwise(F.col("text_key")).alias("part"),
                        "width", "length", "tokens", "plain",
                        F.explode(F.when(found, F.col("literal")).otherwise(F.col("every"))).alias("at"))
    rows = rows.select("item_id", "part", "width", "at",
                       F.slice("tokens", F.col("at"), F.col("width")).alias("template"),
                       F.slice("plain", F.col("at"), F.col("width")).alias("plain"), "length")
    rows = rows.groupBy("item_id", "part", "width", "at", "template", "plain").agg(F.max("length").alias("length"))
    sizes = rows.groupBy("item_id", "part").agg(F.count(F.lit(1)).alias("item_windows"),
                                                F.max("length").alias("item_tokens"))
    return rows.drop("length").join(sizes, ["item_id", "part"])


def _met(texts: DataFrame, known: DataFrame, by: str, width: int) -> DataFrame:
    """Places of ``texts`` (doc_id, text_key, tokens) whose window has the key of a known one."""
    side = with_window_keys(known, by, width).withColumn("key", F.element_at("keys", 1)).drop("keys")
    small = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    side = (F.broadcast(side) if small else side).alias("b")
    # exploded rows are narrow; the outer form keeps the optimizer from filtering on the keys,
    # which would evaluate all steps behind them once more for each mention
    keys = with_window_keys(texts, "tokens", width).select(
        "doc_id", "text_key", F.posexplode_outer("keys").alias("at", "key"))
    return keys.alias("d").join(side, F.col("d.key") == F.col("b.key")).select(
        "d.doc_id", "d.text_key", (F.col("d.at") + 1).alias("place"), "b.item_id", "b.part", "b.width",
        "b.item_windows", "b.item_tokens", "b.at", "b.template", F.col("b.plain").alias("asked"),
        F.lit(by == "template").alias("by_template"))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          min_share: float = MIN_SHARE, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, slots, exact) per leaked item and document."""
    known = written(benchmark_windows(benchmark, window), "benchmark-windows")
    rows = (docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"),
                        F.xxhash64("text").alias("text_key")).where("text IS NOT NULL"))
    cut = {by: rows.select("doc_id", "text_key", tokens(F.col("text")).alias("tokens"))
           for by, tokens in (("template", template_tokens), ("plain", plain_tokens))}
    met = _met(cut["template"], known.where("part = 0"), "template", window)
    for width in sorted(r["width"] for r in known.select("width").distinct().collect()):
        met = met.unionByName(_met(cut["plain"], known.where(F.col("width") == width), "plain", width))
    met = written(met.distinct(), "window-hits")
    # the few texts with a hit are cut once more, for their words
    some = written(met.select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_")).distinct(), "hit-texts")
    same = rows["doc_id"].eqNullSafe(some["id_"]) & (rows["text_key"] == some["key_"])
    texts = (rows.join(some, same, "left_semi").dropDuplicates(["doc_id", "text_key"])
             .select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"),
                     template_tokens(F.col("text")).alias("own"), plain_tokens(F.col("text")).alias("words")))
    hits = (met.join(written(texts, "hit-words"), F.col("doc_id").eqNullSafe(F.col("id_"))
                     & (F.col("text_key") == F.col("key_")))
            .withColumn("found", F.slice("words", F.col("place"), F.col("width")))
            .where(F.when(F.col("by_template"), F.slice("own", F.col("place"), window) == F.col("template"))
                   .otherwise(F.col("found") == F.col("asked")))
            .withColumn("shift", F.col("place") - F.col("at")))
    # slots as (benchmark value, document value); a window without a slot keeps one null row
    slots = F.filter(F.arrays_zip("template", "asked", "found"), lambda x: _is_slot(x["template"]))
    text = ("doc_id", "text_key", "item_id", "part", "width", "item_windows", "item_tokens")
    pairs = hits.select(*text, "shift", "at", "by_template", F.explode_outer(slots).alias("slot"))
    pair = F.when(F.col("slot").isNotNull(), F.struct("slot.asked", "slot.found"))
    own = F.col("by_template")
    aligned = pairs.groupBy(*text, "shift").agg(
        F.collect_set("at").alias("ats"), F.collect_set(pair).alias("values"),
        F.collect_set(F.when(own, F.col("at"))).alias("own_ats"),
        F.collect_set(F.when(own, pair)).alias("own_values"))
    for name, values in (("", "values"), ("own_", "own_values")):
        asked = F.size(F.array_distinct(F.transform(values, lambda x: x["asked"])))
        aligned = (aligned.withColumn(f"{name}slots", asked.cast("long"))
                   .withColumn(f"{name}same", F.col(f"{name}slots") == F.size(values))
                   .withColumn(f"{name}changed", F.exists(values, lambda x: x["asked"] != x["found"]).cast("int")))
    # template windows alone decide first: a plain one may add to them, not speak against them
    needed = F.lit(min_share) * F.col("item_windows")
    aligned = (aligned.withColumn("own_windows", F.size("own_ats").cast("long"))
               .withColumn("alone", F.col("own_same") & (F.col("own_windows") >= needed))
               .withColumn("ats", F.when(F.col("same"), F.col("ats")).otherwise(F.col("own_ats")))
               .withColumn("slots", F.when(F.col("same"), F.col("slots")).otherwise(F.col("own_slots")))
               .withColumn("changed", F.when(F.col("same"), F.col("changed")).otherwise(F.col("own_changed")))
               .where(F.col("same") | F.col("own_same") & (F.col("own_windows") > 0))
               .drop("values", "own_values", "own_ats"))
    # a row is an alignment; a far one starts another place of the text
    by_shift = Window.partitionBy(*text).orderBy("shift")
    far = F.coalesce(F.col("shift") - F.lag("shift").over(by_shift) > F.col("item_tokens"), F.lit(False))
    placed = aligned.withColumn("far", far.cast("int")).withColumn("near", F.sum("far").over(by_shift))
    places = (placed.groupBy(*text, "near")
              .agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"),
                   F.max("slots").alias("all_slots"), F.max("changed").alias("all_changed"),
                   F.max(F.when(F.col("alone"), F.col("own_windows"))).alias("windows"),
                   F.max(F.when(F.col("alone"), F.col("own_slots"))).alias("slots"),
                   F.min(F.when(F.col("alone"), F.col("own_changed"))).alias("changed"))
              .withColumn("tokens", F.size(F.array_distinct(F.flatten(F.transform(
                  "ats", lambda at: F.sequence(at, at + F.col("width") - 1))))))
              .where((F.col("tokens") >= needed + F.col("width") - 1) | (F.col("tokens") >= min_tokens)))
    return (places.groupBy("doc_id", "item_id", "item_windows")
            .agg(F.coalesce(F.max("windows"), F.max(F.size("ats")).cast("long")).alias("windows"),
                 F.coalesce(F.max("slots"), F.max("all_slots")).alias("slots"),
                 (F.coalesce(F.min("changed"), F.min("all_changed")) == 0).alias("exact")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns are kept."""
    bad = written(leaks(docs, benchmark).select(F.col("doc_id").alias("leaked")).distinct(), "leaks")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["leaked"]), "left_anti")
