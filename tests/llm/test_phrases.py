"""Collocations against a plain version."""

import random
import re
from collections import Counter

import pytest

from podium.llm import phrases
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, lang string, rank string, phrase string"


def plain(rows, least, top):
    f, total = {}, Counter()
    for _, text, lang in rows:
        counts = f.setdefault("und" if lang is None else lang, Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[tuple(words[i:i + n])] += 1
    out = []
    for lang, counts in f.items():
        n = total[lang]
        candidates = {p for p, a in counts.items() if len(p) > 1 and a >= least}
        inner = {}
        for p in candidates:
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner[p[i:i + size]] = max(inner.get(p[i:i + size], 0), counts[p])
        kept = []
        for p in candidates:
            a = counts[p]
            if 100 * inner.get(p, 0) >= 100 * a:
                continue
            score, k = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def corpus(seed=2):
    rng = random.Random(seed)
    words = ["the", "of", "New", "YORK", "Éa", "éa", "x#1", "state", "time", "a b", "zz"]
    fixed = ["New York state of", "time of the zz", "x#1 x#1 x#1 x#1 x#1 x#1", "the éa Éa"]
    rows = []
    for i in range(300):
        text = ""
        for _ in range(rng.randint(0, 12)):
            text += rng.choice([" ", "\t ", ". ", ",", "\n", "?!", "  "])
            text += rng.choice(fixed) if rng.random() < 0.5 else rng.choice(words)
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None])))
    rows += [(None, "New York " * 40, "en"), (5, None, "en"), (5, "", None), (6, ".\t. ", "xx"), (6, "new york", "und")]
    rows += [(7, " ".join(rng.choices(words, k=4000)), "en"), (8, "w" * 9000 + " end", "de")]
    return rows


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("filter_bytes", [phrases.FILTER_BYTES, 64])
def test_collocations_equal_brute_force(spark, filter_bytes):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = result(phrases.collocations(docs, 50, filter_bytes))
    assert got == plain(rows, phrases.MIN_COUNT, 50) and len(got) > 20


def test_slices_and_blocks_lose_no_gram(monkeypatch):
    import pyarrow as pa
    rows = corpus()
    batch = pa.RecordBatch.from_pydict({
        "d": pa.array([r[0] for r in rows], pa.int64()), "t": pa.array([r[1] and r[1].encode() for r in rows], pa.binary()),
        "l": pa.array([r[2] or "und" for r in rows], pa.string())})

    def counts():
        out = Counter()
        for lang, grams, giants in phrases._blocks(iter([batch])):
            for side in (0, 1):
                assert len(set(grams.prints(grams.whole(1), 1, side).tolist())) == len(
                    {grams.text(k, 1, giants) for k in grams.whole(1).tolist()})
            for n in range(1, 6):
                out.update((lang, n, grams.text(k, n, giants)) for k in grams.whole(n).tolist())
        return out

    plain_counts = Counter()
    for _, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            plain_counts.update((lang or "und", n, " ".join(words[i:i + n]).encode())
                                for n in range(1, 6) for i in range(len(words) - n + 1))
    assert counts() == plain_counts
    monkeypatch.setattr(phrases, "SLICE", 13)
    monkeypatch.setattr(phrases, "GIANT", 20)
    assert counts() == plain_counts


def test_equal_fingerprints_of_unlike_texts(monkeypatch):
    """All fingerprints of a length collide: the digests keep the counts apart."""
    import numpy as np
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"d": pa.array([1, 2], pa.int64()),
                                        "t": pa.array([b"a b a. b c", b"a b"], pa.binary()), "l": ["x", "x"]})
    plain_prints = phrases.Grams.prints
    monkeypatch.setattr(phrases.Grams, "prints", lambda self, at, n, side=0: plain_prints(
        self, at, n, side) if side else np.full(len(at), n, np.uint64))
    counts, first = Counter(), {}
    for rows in phrases._counted((1, 2, 3), None, None)(iter([batch])):
        for r in rows.to_pylist():
            counts[r["print"], r["digest"]] += r["a"]
            first[r["print"], r["digest"]] = min(r["doc"], first.get((r["print"], r["digest"]), 99))
    assert sorted((k[0], a, first[k]) for k, a in counts.items()) == [
        (1, 1, 1), (1, 3, 1), (1, 3, 1), (2, 1, 1), (2, 1, 1), (2, 2, 1), (3, 1, 1)]


def test_exact_products(spark):
    big = 9 * 10 ** 17
    rows = [("x", 0, "", big, 1), ("x", 1, "p", 10 ** 17 + 3, 1), ("x", 1, "q", 10 ** 17 + 7, 1),
            ("x", 2, "p q", 10 ** 16 + 1, 1)]
    df = spark.createDataFrame(rows, "lang string, n int, phrase string, a long, doc long")
    assert phrases.scored(df).first().score == 1000 * (10 ** 16 + 1) * big // ((10 ** 17 + 3) * (10 ** 17 + 7))


def test_smoke_table(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert result(phrases.collocations(docs)) == plain(rows, phrases.MIN_COUNT, phrases.TOP)


def test_empty_table(spark):
    df = phrases.collocations(spark.createDataFrame([], SCHEMA))
    assert df.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and df.count() == 0
