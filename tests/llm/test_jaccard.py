"""Jaccard join against all-pairs brute force."""

import random
import re

import numpy as np
import pytest

from podium.llm import jaccard
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, class_id string, rep string, bands string"


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """doc -> (class, links, copies) over documents with a lowest n-gram set each."""
    docs = {d: grams(t) for d, t in rows}
    reps = {}
    for d in sorted(docs):
        if docs[d]:
            reps.setdefault(docs[d], []).append(d)
    near = {s: [] for s in reps}
    sets = list(reps)
    for i, a in enumerate(sets):
        for b in sets[:i]:
            common = len(a & b)
            if common >= 0.8 * (len(a) + len(b) - common) - 1e-9:
                near[a].append(b)
                near[b].append(a)
    label = {}
    for s in sorted(sets, key=lambda s: reps[s][0]):
        if s in label:
            continue
        stack, label[s] = [s], reps[s][0]
        while stack:
            for other in near[stack.pop()]:
                if other not in label:
                    label[other] = reps[s][0]
                    stack.append(other)
    return {d: (label[s], len(near[s]), len(reps[s])) if s else (d, 0, 1) for d, s in docs.items()}


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []

    def add(text):
        rows.append((len(rows) + 1, text))

    for _ in range(40):
        add(" ".join(rng.choices(vocabulary, k=rng.randint(1, 90))))
    base = rng.choices(vocabulary, k=120)
    for _ in range(120):  # a large group whose members differ from each other by degrees
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        add(" ".join(words))
    chain = rng.choices(vocabulary, k=100)
    for _ in range(25):  # a chain: neighbours are near, the ends are not
        chain = chain[2:] + rng.choices(vocabulary, k=2)
        add(" ".join(chain))
    for _ in range(30):
        add(rows[5][1])
    add(rows[5][1].upper())
    for text in ("", None, " . ", "one two three", "One, two three!", "one two"):
        add(text)
    add(" ".join(rng.choices(vocabulary, k=30000)))
    return rows


@pytest.mark.parametrize("block", [8, jaccard.BLOCK])
def test_join_equals_brute_force(spark, block):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "c", "r", "b") for r in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"])
           for r in jaccard.join(frame, block=block).collect()}
    assert got == brute(rows)
    kept = {r["doc_id"] for r in jaccard.clean(frame).collect()}
    assert kept == {d for d, v in got.items() if d == v[0]}


def test_smoke_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard.join(docs).collect()}
    assert got == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None)]
    frame = spark.createDataFrame([(*r, "c", "r", "b") for r in rows], SCHEMA)
    got = {r["doc_id"]: r["class_id"] for r in jaccard.join(frame).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert sorted(r["doc_id"] or 0 for r in jaccard.clean(frame).collect()) == [0, 1, 1, 3]
    assert jaccard.join(frame.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands()
    assert 1 - (1 - 0.8 ** rows) ** bands >= jaccard.RECALL and bands * rows <= jaccard.MAX_HASHES


def test_components_of_a_long_path(spark):
    ids = np.random.default_rng(0).permutation(200).tolist()
    edges = spark.createDataFrame([(a, b) for a, b in zip(ids, ids[1:])] + [(500, 501)], "src long, dst long")
    got = {r["node"]: r["class_id"] for r in jaccard.components(edges).collect()}
    assert got == {**{i: 0 for i in ids}, 500: 500, 501: 500}


def test_tasks_hand_free_memory_back(spark):
    # idle Python workers kept what the join had used while the next stage ran
    import psutil
    from podium.llm.common import releasing

    def fill(batches):
        rows = [bytes(100) + str(i).encode() for i in range(2_000_000)]
        keep = [rows[-1]]  # the last of the heap stays in use
        rows = None
        yield from (b for b in batches if keep)

    held = psutil.Process()
    list(releasing(fill)(iter([1])))
    before = held.memory_info().rss
    assert list(releasing(fill)(iter([1, 2]))) == [1, 2]
    assert held.memory_info().rss - before < 100 << 20


def test_sets_do_not_depend_on_block_and_memo(monkeypatch):
    from podium.llm import jaccard
    texts = [" ".join(f"w{i * j % 97}" for j in range(n)) for i, n in enumerate([3, 400, 0, 7, 2000, 5])] + [None]

    def sets():
        return {int(o): v.tolist() for owner, counts, values in jaccard.Shingler().sets(texts)
                for o, v in zip(owner, np.split(values, np.cumsum(counts)[:-1]))}

    whole = sets()
    monkeypatch.setattr(jaccard, "CHARS", 50)
    monkeypatch.setattr(jaccard, "MEMO", 3)
    assert sets() == whole
