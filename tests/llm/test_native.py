"""Quality cascade and decontamination: brute force, planted cases, odd rows, native plans."""

import re
from collections import Counter

import pytest

from podium.llm import decontamination as dec
from podium.llm import quality
from tests.conftest import SMOKE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = ("The committee met on a rainy morning to talk about the plan for the river bank. Some members "
         "had walked there the day before and they brought drawings of the old wall. Nobody was sure "
         "how long the stones would hold, but all agreed that work should start before winter came "
         "back to the valley and the water rose again over the path.")


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", "  \n\t", PROSE, "a b c a b c", "x x x x", "a\nb\na\n\n \na", "## " * 60, PROSE + "\n" + PROSE,
         PROSE.upper(), PROSE.replace(" ", " !! "), " ".join(f"w{i}é" for i in range(30000)),
         "word " * 20000, PROSE.replace(".", "\x0b\x0c"), "<|>" + PROSE, PROSE.replace(" the ", " 12 34 56 ")]


def test_measures_equal_brute_force(spark):
    rows = [(i, t, 0, "x") for i, t in enumerate(TEXTS)] * 2 + [(None, PROSE, 0, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words int, words string").repartition(3)
    out = quality.judge(frame).collect()
    assert len(out) == len(rows)
    for r in out:
        text = PROSE if r["doc_id"] is None else TEXTS[r["doc_id"]]
        want = brute_measures(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = {r["doc_id"] for r in out if r["kept"]}
    assert {3, 11, 13} <= kept and not kept & {0, 1, 2, 4, 5, 6, 7, 8, 9, 10, 12}
    assert quality.judge(frame.limit(0)).count() == 0


def test_order_changes_no_verdict(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    names = list(quality.rules())
    assert sorted(quality.rule_order(docs, 50)) == sorted(names)
    a = quality.judge(docs, names)
    assert a.exceptAll(quality.judge(docs, names[::-1])).count() == 0


def test_quality_and_leaks_run_no_python(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    items = spark.read.parquet(f"{SMOKE}/benchmark.parquet")
    for frame in (quality.judge(docs, list(quality.rules())), dec.leaks(docs, items)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


QUESTION = ("Alice bought 12 apples and 5 km of rope for her brother Bob, and then Alice gave "
            "3 apples back to the shop. How many apples does Alice have left at the end?")
ITEMS = [(1, QUESTION, "x"), (1, QUESTION, "x"), (2, None, "x"), (3, "too short to find", "x"),
         (4, "Completely different words make up this second item so that nothing here can match it.", "x")]
CHANGED = (QUESTION.replace("Alice", "Zoe").replace("Bob", "Max").replace("12", "98").replace("5 km", "7 miles")
           .replace("3", "6.5"))
DOCS = [
    (1, PROSE + " " + QUESTION + " " + PROSE, {(1, True)}),
    (2, PROSE + "\n" + CHANGED.replace(" ", "\n") + "\n" + PROSE, {(1, False)}),
    (3, CHANGED.replace("Zoe have", "Eve have").replace("then Zoe", "then Ann"), set()),  # slots disagree
    (4, PROSE, set()), (5, None, set()), (6, "", set()), (7, "too short to find", set()),
    (8, ITEMS[4][1].lower() + " " + QUESTION.upper(), set()),
    (9, " ".join([PROSE] * 60) + " " + ITEMS[4][1] + " " + QUESTION, {(1, True), (4, True)}),
    (None, QUESTION, {(1, True)}),
]


@pytest.mark.parametrize("rows", [10**6, 0])  # broadcast, and the shuffle beyond its bound
def test_planted_leaks(spark, rows, monkeypatch):
    monkeypatch.setattr(dec, "BROADCAST_ROWS", rows)
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t, _ in DOCS] * 2,
                                 "doc_id long, text string, tokens string, at string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string, template string")
    got = {}
    for r in dec.leaks(docs, items).collect():
        got.setdefault(r["doc_id"], set()).add((r["item_id"], r["exact"]))
    want = {d: w for d, _, w in DOCS if w}
    # lower case changes a name to a word: item 4 starts with one, the rest still matches
    assert {d: w for d, w in got.items() if d != 8} == want
    kept = dec.clean(docs, items)
    assert kept.columns == docs.columns
    assert not {r["doc_id"] for r in kept.collect()} & set(want)
    assert kept.where("doc_id IN (3, 4, 5, 6, 7)").count() == 10
    assert dec.leaks(docs.limit(0), items).count() == 0 and dec.leaks(docs, items.limit(0)).count() == 0


def plain_rows(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, text string")


def test_inserted_and_deleted_words(spark):
    word = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    median, short, long = word[:38], word[40:56], word[60:360]
    items = plain_rows(spark, [(1, " ".join(median)), (2, " ".join(short)), (3, " ".join(long))], "item_id")
    other = " ".join(word[370:400] * 3)
    split = [*median[:13], "really", *median[13:25], "quite", *median[25:]]
    texts = {1: split, 2: [*median[:12], *median[13:26], *median[27:]], 3: [*short[:8], "really", *short[8:]],
             4: long[100:160],  # 60 words of 300
             5: median[:14], 6: short[:9], 7: long[:40],  # too little of each
             8: [*median[:9], *word[370:400] * 3, *median[20:29]]}  # two far phrases are no copy
    docs = plain_rows(spark, [(d, f"{other} {' '.join(t)} {other}") for d, t in texts.items()], "doc_id")
    got = {(r["doc_id"], r["item_id"], r["exact"]) for r in dec.leaks(docs, items).collect()}
    assert got == {(1, 1, True), (2, 1, True), (3, 2, True), (4, 3, True)}


def test_exact_copies_without_case_and_templates(spark):
    title = "The Old Mill Near River Dale Was Built By Thomas Green And His Brother Paul"
    german = "Der Hund Und Die Katze Laufen Durch Den Wald Nach Hause Zum Essen"
    numbers = "17 4 99 23 8 15 42 61 7 30 12"
    named = "Yesterday Alice met Robert near Berlin while Carol wrote Daniel about Emma and then Frank left"
    items = [(4, ITEMS[4][1]), (1, QUESTION), (11, title), (12, german), (13, numbers),
             (14, "what do purple badgers eat"), (15, "Name the seven hills of Rome"), (16, named)]
    texts = {8: DOCS[7][1], 21: title, 22: german.lower(), 23: numbers, 24: "so: What do purple badgers eat?!",
             25: "NAME THE SEVEN HILLS OF ROME", 26: named.lower(), 27: named.upper(), 28: numbers[::-1],
             29: "what do purple cats eat", 30: "name the seven lakes of rome"}
    docs = plain_rows(spark, [(d, f"{PROSE} {t} {PROSE}") for d, t in texts.items()], "doc_id")
    got = {(r["doc_id"], r["item_id"], r["exact"]) for r in dec.leaks(docs, plain_rows(spark, items, "item_id")).collect()}
    want = {8: (1, 4), 21: (11,), 22: (12,), 23: (13,), 24: (14,), 25: (15,), 26: (16,), 27: (16,)}
    assert got == {(d, i, True) for d, found in want.items() for i in found}
