"""Language models and toxicity: brute-force probabilities, held-out accuracy, odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from podium.llm import language_id as lid
from podium.llm import toxicity
from podium.llm.common import PieceTable
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, lang string, source string, score double, found string"
SYLLABLES = {"aa": "ka lo mi ne ru".split(), "bb": "schi tze ber ung ach".split()}


def words(lang, rng, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def corpus():
    rng = random.Random(5)
    rows = [(i, words(lang, rng, 60), lang, "s", 0.0, "x") for i, lang in
            enumerate(["aa", "bb"] * 60)]
    return rows + [(1000, None, "aa", "s", 0.0, "x"), (1001, "", "bb", "s", 0.0, "x"),
                   (1002, "12 34 !!", None, "s", 0.0, "x"), (None, words("aa", rng, 30), "bb", "s", 0.0, "x"),
                   (1003, words("bb", rng, 40000), None, "s", 0.0, "x"),
                   (1004, "Ж" * 300 + " 日本語の文章 " * 30, None, "s", 0.0, "x"), (1, rows[1][1], "bb", "s", 0.0, "x")]


def brute_chances(texts):
    """Interpolated Kneser-Ney over padded words, by dictionaries of real n-grams."""
    n, counts = lid.ORDER, Counter()
    for text in texts:
        for piece in text.lower().split():
            padded = " " * (n - 1) + piece + " "
            counts.update(padded[i - n + 1:i + 1] for i in range(n - 1, len(padded)))
    tables, level = [], dict(counts)
    for _ in range(n):
        one, two = sum(c == 1 for c in level.values()), sum(c == 2 for c in level.values())
        d = one / (one + 2 * two) if one and two else 0.5
        total, kinds = defaultdict(float), Counter()
        for g, c in level.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        tables.append((level, d, total, kinds))
        level = Counter(g[1:] for g in level)

    def chance(gram):
        p = 1 / (len(tables[-1][0]) + 1)
        for k in range(1, n + 1):
            level, d, total, kinds = tables[n - k]
            g = gram[n - k:]
            t = total.get(g[:-1])
            p = (max(level.get(g, 0) - d, 0) + d * kinds[g[:-1]] * p) / t if t else p
        return p

    return chance


def test_probabilities_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [words("aa", rng, 50) for _ in range(8)]
    frame = spark.createDataFrame([(i, t, "aa", "s", 0.0, "x") for i, t in enumerate(texts)], SCHEMA)
    counts = lid.gram_counts(frame).toPandas()
    model, chance = lid.CharModel(counts), brute_chances(texts)
    for word in ("kalo", "miqq", "z", "rurune"):
        found, sizes = lid.grams([word])
        padded = " " * (lid.ORDER - 1) + word + " "
        want = [chance(padded[i - lid.ORDER + 1:i + 1]) for i in range(lid.ORDER - 1, len(padded))]
        assert sizes.tolist() == [len(word) + 1]
        assert model.chances(found) == pytest.approx(want)


def test_identification_and_odd_rows(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(4)
    models = lid.train(docs)
    assert sorted(models) == ["aa", "bb"]
    out = lid.identify(docs, models).collect()
    assert len(out) == len(corpus())
    got = {r["doc_id"]: r for r in out}
    for i in range(120):
        assert got[i]["lang_pred"] == ["aa", "bb"][i % 2] and not got[i]["rejected"]
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i]["score"] <= 1
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[1003]["lang_pred"] == "bb" and got[None]["lang_pred"] == "aa"
    assert got[1004]["rejected"]
    kept = lid.clean(docs, models)
    assert kept.columns == docs.columns and kept.count() == len(corpus()) - 4
    none = docs.limit(0)
    assert lid.train(none) == {} and lid.identify(none, {}).count() == 0
    assert {r["lang_pred"] for r in lid.identify(docs, {}).collect()} == {"und"}


def test_memo_reset_changes_nothing():
    rng = random.Random(1)
    texts = [words("aa", rng, 200) + " " + words("bb", rng, 200) for _ in range(20)]
    counts = {}
    found, sizes = lid.grams(texts[0].split())
    import pandas as pd
    frame = lid._summed(pd.DataFrame(found).assign(n=1).astype(np.int64))
    models = {"aa": lid.CharModel(frame)}
    small = lid.Identifier(models)
    small.memo.limit = 10
    a, b = small.judge(texts), lid.Identifier(models).judge(texts)
    assert counts == {} and np.allclose(a["entropy"], b["entropy"])


def test_smoke_languages(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    out = lid.identify(docs, lid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97
    assert out.where("rejected").count() == 0


def toxic_corpus(n=1200):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        bad = i % 8 == 0
        text = words(["aa", "bb"][i % 2], rng, 80).split()
        for _ in range(rng.randint(1, 4) if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(["idiot", "clown", "scum" + rng.choice("abcdef") + "x"])
        rows.append((i, " ".join(text), "aa", "s", 0.0, "x"))
        if i % 3 == 0:
            labels.append((i, int(bad)))
    for j in range(200):  # copies of one toxic text must not make its other words toxic
        rows.append((n + j, rows[0][1], "aa", "s", 0.0, "x"))
        labels.append((n + j, 1))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows + [(None, "idiot", None, None, 0.0, "x"), (5000, None, None, None, 0.0, "x"),
                                         (5001, "", None, None, 0.0, "x"), (5001, "", None, None, 0.0, "x")], SCHEMA)
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + 4
    truth = [(r["predicted"], int(r["doc_id"] % 8 == 0)) for r in out
             if r["held_out"] and r["doc_id"] < 1200]
    assert np.mean([a == b for a, b in truth]) > 0.95 and sum(b for _, b in truth) > 20
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for r in out if not r["predicted"])


def test_toxicity_without_positives(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert len({r["score"] for r in toxicity.score(docs, model).collect()}) == 1
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_negative_risk_is_not_followed():
    rng = np.random.default_rng(0)
    positive = [np.array([1, int(x)], np.int32) for x in rng.integers(10, 2000, 40)]
    unlabelled = [np.array([int(x)], np.int32) for x in rng.integers(10, 2000, 400)] + positive[:20]
    model = toxicity.fit(positive, unlabelled, 0.05)
    assert model.weights[1] > 1 and np.isfinite(model.weights).all()


def test_long_text_scores_by_block():
    pieces = PieceTable(toxicity._bins, np.int32)
    model = toxicity.Model(np.ones(toxicity.FEATURES, np.float32) * 0.001, -1.0)
    text = "word " * 1000 + "end"
    assert model.scores([text, None], pieces)[1] == pytest.approx(1 / (1 + np.e))
