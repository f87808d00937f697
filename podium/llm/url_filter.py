"""URL filtering with a weighted vocabulary and an Aho-Corasick automaton.

One scan of a lower-cased url finds every strict and soft term. A hit counts when it is
bounded on both sides by something other than an ASCII letter or digit. A url is rejected on one
strict term or on soft terms whose distinct hits weigh ``limit`` or more. Host and path
rules come first: the longest rule that fits decides, whatever the vocabulary says.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and,
without a term, is allowed; repeated rows are judged alike; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# term -> weight; a strict term rejects alone
STRICT = ("adult", "casino", "malware", "phishing", "porn", "spam", "viagra", "warez", "xxx")
SOFT = {"ads": 1, "bet": 1, "bets": 1, "bonus": 1, "cheap": 1, "deal": 1, "deals": 1, "farm": 1,
        "free": 1, "loan": 1, "loans": 1, "pills": 1, "poker": 1, "promo": 1, "slots": 1,
        "sponsored": 1, "track": 1, "tracker": 1, "win": 1}
SOFT_LIMIT = 2
# (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, null if none does."""
    text = verdict = None
    for verdict_, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = (((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path))
        text = F.when(fits, rule_host + rule_path) if text is None else \
            text.when(fits, rule_host + rule_path)
        verdict = F.when(fits, verdict_) if verdict is None else verdict.when(fits, verdict_)
    if text is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, verdict


def term_hits(strict=STRICT, soft=SOFT):
    """A vectorised function of lower-cased urls -> (strict hits, distinct soft weight)."""
    import ahocorasick

    @F.pandas_udf("struct<strict: int, soft: int>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tree = ahocorasick.Automaton()
        for term in strict:
            tree.add_word(term, (term, 0))
        for term, weight in soft.items():
            tree.add_word(term, (term, weight))
        tree.make_automaton()
        for urls in batches:
            out = []
            for url in urls:
                found = {}
                for end, (term, weight) in tree.iter(url or ""):
                    start = end - len(term) + 1
                    if not ((start and url[start - 1] in WORD) or url[end + 1:end + 2] in WORD):
                        found[term] = weight
                out.append((sum(not w for w in found.values()), sum(found.values())))
            yield pd.DataFrame(out, columns=["strict", "soft"])

    return hits


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT,
               soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """Per row of ``pages`` (page_id, url): host, path, rule, verdict, strict and soft hits."""
    host, path = split_url(F.col("url"))
    frame = (pages.select("page_id", "url", host.alias("host"), path.alias("path"))
             .withColumn("hits", term_hits(strict, soft)(F.translate("url", _UPPER, _LOWER))))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("hits.strict") > 0) | (F.col("hits.soft") >= soft_limit),
                 "block").otherwise("allow")
    return frame.select("page_id", "host", "path", rule.alias("rule"),
                        F.coalesce(ruled, own).alias("verdict"),
                        F.col("hits.strict").alias("strict_hits"),
                        F.col("hits.soft").alias("soft_weight"))
