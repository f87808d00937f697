"""Document quality rules as a short-circuit cascade of native expressions.

Base measures are needed for every row. The further rules are independent tests, and a
document is kept if it fails none, so their order changes only the cost. ``rule_order`` times
each rule and counts its rejections on a sample of at most ``SAMPLE_ROWS`` rows and sorts by
rejections per second; ``judge`` chains the rules in that order in one CASE, which stops at
the first rule that fails.

Words are runs of ``[^\\x20\\x09-\\x0D]``. Repeated words are found by sorting the hashed 3-word
windows of a text with their positions: equal neighbours mark repeated windows, and the
covered positions are counted in one more pass, so a long text costs n log n.

Defined cases: a null or blank text has no words and fails the base; repeated rows are judged
alike; an empty table gives no rows and keeps the rules in their written order; extra columns
are ignored.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
SAMPLE_ROWS = 2000


def _count(pattern: str, text: Column) -> Column:
    """Characters of ``text`` left when all but those of the class are removed."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def rules() -> dict[str, Column]:
    """Further rules: true where a document is rejected. Columns: text_, words, measures."""
    n = F.col("n_words")
    text, words, lines = F.col("text_"), F.col("words"), F.col("n_lines")
    return {
        "mean_word_length": (F.col("word_chars") < n * 2) | (F.col("word_chars") > n * 15),
        "symbols": F.col("n_symbols") * 10 > n,
        "duplicate_lines": F.col("n_dup_lines") * 2 > lines,
        "exclamations": _count(r"[^!]+", text) * 10 > n * 3,
        "ellipses": F.size(F.split(text, r"(?:\.\.\.|…)[ \t]*(?:\n|$)")) - 1 > 0.3 * lines,
        "capitals": _count(r"[^\p{Lu}]+", text) * 2 > _count(r"[^\p{L}]+", text),
        "words_with_letters": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) * 10 < n * 7,
        "vocabulary": F.size(F.array_distinct(words)) * 10 < n,
    }


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, text_, words and the base measures of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    frame = (docs.select(F.col("doc_id").alias("doc_id"), text.alias("text_"))
             .withColumn("words", F.regexp_extract_all("text_", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
             .withColumn("lines_", F.filter(F.split("text_", "\n"),
                                            lambda x: x.rlike(r"[^\x20\x09-\x0D]"))))
    frame = frame.select(
        "doc_id", "text_", "words", F.size("words").cast("long").alias("n_words"),
        F.size("lines_").cast("long").alias("n_lines"),
        _count(SPACE, F.col("text_")).alias("word_chars"),
        _count(SYMBOLS, F.col("text_")).alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"))
    return _with_repeats(frame)


def _with_repeats(frame: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside 3-word windows that occur twice or more."""
    keep = frame.columns
    windows = F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    frame = frame.withColumn("windows_", windows)
    placed = F.transform("windows_", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    frame = frame.select(*keep, F.when(
        F.size(F.array_distinct("windows_")) < F.size("windows_"), F.sort_array(placed)).alias("placed_"))

    def hash_at(i):
        return F.get(F.col("placed_"), i).getField("h")

    repeated = F.filter("placed_", lambda x, i: x["h"].eqNullSafe(hash_at(i - 1))
                        | x["h"].eqNullSafe(hash_at(i + 1)))
    frame = frame.select(*keep, F.sort_array(F.transform(repeated, lambda x: x["at"])).alias("at_"))
    covered = F.transform("at_", lambda p, i: F.coalesce(
        F.least(F.lit(3), p - F.get(F.col("at_"), i - 1)), F.lit(3)))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return frame.select(*keep, F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def rule_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[str]:
    """Rule names by rejections per second on a sample; the verdicts do not depend on it."""
    # a share of the rows, so that about sample_rows rows in all reach the limit
    share = sample_rows / max(1, docs.count())
    picked = docs.select("doc_id", "text").where(F.rand(seed) < share).limit(sample_rows)
    # written before it is filtered: a filter pushed below the measures would inline them
    sample = written(measures(picked), "quality-sample").where(~base_failed())
    found = rules()
    counts = sample.agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("int")).alias(k)
                          for k, c in found.items()]).first()

    def seconds(expression: Column) -> float:
        query = sample.agg(F.sum(expression.cast("int")))
        query.collect()  # compile first
        began = time.perf_counter()
        query.collect()
        return time.perf_counter() - began

    floor = seconds(F.col("n_words") < 0)
    rate = {k: (counts[k] or 0) / max(1e-3, seconds(c) - floor) for k, c in found.items()}
    return sorted(found, key=lambda k: -rate[k])


def judge(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, measures, base_failed and kept."""
    found = rules()
    order = rule_order(docs) if order is None else order
    kept = F.when(base_failed(), F.lit(False))
    for name in order:
        kept = kept.when(found[name], F.lit(False))
    return measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), kept.otherwise(F.lit(True)).alias("kept"))
