"""Removal of repeated byte strings against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from podium.llm import suffix_dedup as sd
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, block long, ids string, answers string"


def plain(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, b in texts:
        for i in range(len(b) - 199):
            s = b[i:i + 200]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for doc_id, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=4):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices("abcdefgh éß.", k=n))
    passages = [text(n) for n in (199, 200, 201, 256, 300, 520, 1500)]
    rows = []

    def add(t):
        rows.append((len(rows), t))

    for _ in range(120):
        t = text(rng.randint(0, 500))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.4:  # an excerpt, or a copy with a change inside
                i = rng.randrange(len(p))
                p = p[i:] if rng.random() < 0.5 else p[:i] + "#" + p[i + 1:]
            t += p + text(rng.randint(0, 80))
        add(t)
    for _ in range(12):
        add(rows[7][1])
    near = text(3000)
    for _ in range(10):
        w = list(near)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = "!"
        add("".join(w))
    add("z" * 700)
    add("z" * 230)
    add("xy" * 400)
    add("q" * 200)
    rows.extend([(None, None), (5, ""), (5, "short"), (None, "q" * 199), (9, text(40_000) + near)])
    return rows


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def test_cover_takes_any_two_places_to_cover_positions():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))


def test_dedupe_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(4)
    want = plain(rows)
    assert result(sd.dedupe(docs)) == want
    assert 100 < sum(1 for r in want if r[2]) < len(want)


@pytest.mark.parametrize("chunk, unit, block", [(1 << 20, 1 << 21, 3000), (300, 900, 2000), (500, 500, 10 ** 9)])
def test_any_cut_of_blocks_and_chunks_gives_the_same(monkeypatch, chunk, unit, block):
    """The whole search without Spark, with tiny chunks and blocks."""
    monkeypatch.setattr(sd, "CHUNK", chunk)
    monkeypatch.setattr(sd, "UNIT", unit)
    sd._powers.cache_clear()
    rows = corpus(6)
    groups, size = [[]], 0
    for r in rows:
        if size > block:
            groups.append([])
            size = 0
        groups[-1].append(r)
        size += len(r[1] or "")
    answers = [{} for _ in groups]
    search = []
    for g, a in zip(groups, answers):
        texts = [(t or "").encode() for _, t in g]
        search.append(sd.Search(sd.Block(np.array([len(t) for t in texts], np.int64), b"".join(texts)), 7, a))
    for phase in (1, 2, 3):
        buckets = {}
        for i, s in enumerate(search):
            for row in s.send(phase):
                buckets.setdefault(row[1], []).append((i, *row))
        for sent in buckets.values():
            table = pa.Table.from_batches([sd._sent_rows(sent)])
            for r in sd._sorted_bucket(phase)(table).to_pylist():
                answers[r["block"]].setdefault((phase, r["unit"]), {})[r["bucket"]] = r["tied"], r["mixed"]
    got = []
    for g, s in zip(groups, search):
        doc, first, last = sd.removed_spans(s.block, s.repeated())
        for i, (doc_id, text) in enumerate(g):
            spans = [(a, b) for d, a, b in zip(doc, first, last) if d == i]
            b, kept, here = s.block.data, b"", int(s.block.starts[i])
            for x, y in spans:
                kept, here = kept + b[here:x], y
            kept += b[here:int(s.block.ends[i])]
            n = len((text or "").encode())
            got.append((doc_id, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    sd._powers.cache_clear()
    assert sorted(got, key=repr) == plain(rows)


def test_smoke_table(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    assert result(sd.dedupe(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    df = sd.dedupe(spark.createDataFrame([], SCHEMA))
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and df.count() == 0
