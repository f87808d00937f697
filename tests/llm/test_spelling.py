"""Spelling variants against a plain all-pairs version."""

import random
import re
import zlib
from collections import Counter

import pytest

from podium.llm import spelling
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, n long, word string, form string"


def plain_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and is_near(v, w)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    letters = "abcdeoéßÉ×"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(60)] + ["aabbaabb", "bananas"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = list(base[min(int(rng.expovariate(0.08)), len(base) - 1)])
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.4:
                    w[at] = rng.choice(letters[:3])
                elif kind < 0.7:
                    del w[at]
                else:
                    w.insert(at, rng.choice(letters[:3]))
            w = "".join(w)
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((i, rng.choice([" ", ", ", "-1"]).join(words)))
    rows += [(None, "chained chained"), (7, None), (7, ""), (7, rows[3][1]), (8, "1 2 ?!")]
    rows += [(1000 + i, "chainedx " * 6 ** (i % 5)) for i in range(20)]
    rows += [(2000 + i, "chainedxy " * 9 + "chained " * 2) for i in range(9)]
    rows += [(2500 + i, "chainedxyz chainedxyz") for i in range(4)]
    rows += [(3000 + i, "y" * 3000 + " " + "y" * 2999 + " " + "y" * 1500 + "z" + "y" * 1499) for i in range(6)]
    return rows


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 64])
def test_variants_equal_brute_force(spark, filter_bytes):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(5)
    got = result(spelling.variants(docs, filter_bytes))
    want = plain(rows)
    assert got == want
    assert any(v[0] and v[1] != v[0] for v in want.values())  # some chains are longer than one step


def test_smoke_table(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    assert result(spelling.variants(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_slices_cut_no_run(monkeypatch):
    text = "alphabet, betagamma " * 50 + "z" * 500
    whole = spelling.document_words(3, text)
    monkeypatch.setattr(spelling, "SLICE", 7)
    assert spelling.document_words(3, text) == whole


def test_empty_table(spark):
    df = spelling.variants(spark.createDataFrame([], SCHEMA))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and df.count() == 0
