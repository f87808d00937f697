"""URL rules and vocabulary on hand-made urls."""

from podium.llm import url_filter

CASES = [  # url, host, path, rule, verdict
    ("http://A.Example.ORG/es/x", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/123?q", "example.org", "/en/123", "example.org/en/1", "block"),
    ("http://casino.org/x", "casino.org", "/x", "org/", "allow"),
    ("http://casino.org", "casino.org", "", None, "block"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("https://b.com/de/", "b.com", "/de/", "com/de/", "block"),
    ("https://spam.com/fr/1", "spam.com", "/fr/1", "com/fr/", "allow"),
    ("https://free-bets.net/a", "free-bets.net", "/a", None, "block"),
    ("https://free.net/free", "free.net", "/free", None, "allow"),
    ("https://freebets.net/a", "freebets.net", "/a", None, "allow"),
    ("https://x.net/CHEAP/pills#f", "x.net", "/CHEAP/pills", None, "block"),
    ("x://h?free", "h", "", None, "allow"),
    ("no scheme adult", "", "", None, "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("a://", "", "", None, "allow"),
    ("http://x.net/" + "a" * 100_000 + "/xxx", "x.net", "/" + "a" * 100_000 + "/xxx", None, "block"),
]


def test_cases(spark):
    rows = [(i, c[0], "clash") for i, c in enumerate(CASES)] * 2
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string"))
    out = got.collect()
    assert len(out) == 2 * len(CASES)
    for r in out:
        c = CASES[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == c[1:], c[0]


def test_empty_and_other_rules(spark):
    frame = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(frame).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    row = url_filter.judge_urls(one, rules=()).first()
    assert row["rule"] is None and row["verdict"] == "allow"
