"""Spelling variant grouping by Bloom-guided neighbourhoods.

Words are counted in the scan tasks and summed by word. The vocabulary (words of at least
``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences) goes into blocked Bloom filters, one
shard of blocks per word length. Their total size is bounded by ``FILTER_BYTES`` however large
the vocabulary is (then fewer bits fall to a word and more probes pass); only this bounded array
is broadcast. Each word's edits are generated as hashes: one deleted code point, and one code
point replaced by a larger one of the alphabet. That finds every pair once, as an insertion is a
deletion seen from the longer word and replacing is symmetric. Edits that all filters pass are
spelled out and joined with the vocabulary by a shuffle, which removes the false positives.

A word's form is its near word of largest count (ties: the first in code-point order) if that
count is ``RATIO`` times its own or more. Roots come by pointer doubling: counts grow
``RATIO``-fold along a chain, so its length is bounded by the logarithm of the largest count.

Defined cases: a null text has no words, a null doc_id is the empty string in the hash of a
run; rows with one doc_id are rows of their own; a word without near words has n_near 0, no
form and itself as root; an empty table gives no rows; other columns are kept out. Words of any
length are handled (a very long one in slices of its positions).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.bloom import FILTER_BYTES, Shards, filled, filters, probe
from podium.llm.common import written

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DROP_MODULUS = 199
LONGEST_SHARD = 64  # words of this length or more share a shard
SLICE = 1 << 20  # characters read at once
PROBES = 1 << 21  # edits probed at once
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_RUN = re.compile(rf"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}")
_OTHER = re.compile(r"[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _runs(text: str) -> Iterator[list[str]]:
    """Runs long enough to become a word, in lists from slices that cut no run."""
    start = 0
    while start < len(text):
        stop = _OTHER.search(text, start + SLICE)
        end = stop.start() if stop else len(text)
        yield _RUN.findall(text, start, end)
        start = end


def document_words(doc_id, text: str | None) -> Counter:
    """Counts of the words of one document."""
    found: Counter = Counter()
    for runs in _runs(text or ""):
        found.update(runs)
    words: Counter = Counter()
    for run, n in found.items():
        words[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in words.items():
        h = zlib.crc32(run.encode(), start)
        if h % DROP_MODULUS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= MIN_LENGTH:
            out[run] += n
    return out


def _counted(limit: int = 200_000, limit_chars: int = 16 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        chars = 0

        def flushed():
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = document_words(doc_id, text.as_py())
                chars += sum(len(w) for w in words if w not in total)
                total.update(words)
                if len(total) > limit or chars > limit_chars:
                    yield flushed()
                    total.clear()
                    chars = 0
        if total:
            yield flushed()
    return run


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least MIN_COUNT occurrences, each occurrence of every text counted."""
    counts = docs.select("doc_id", F.col("text")).mapInArrow(_counted(), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.full(n, BASE), out=out[1:])
    return out


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, code points) for the words of each length, in bounded groups."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        m = int(lengths[group[0]]) if len(group) else 0
        step = max(1, PROBES // (len(ALPHABET) * max(m, 8)) * 8)
        for i in range(0, len(group), step):
            rows = group[i:i + step]
            codes = np.frombuffer("".join(words[r] for r in rows).encode("utf-32-le"), np.uint32)
            yield m, rows, codes.reshape(len(rows), m).astype(np.uint64)


def _hashes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for m, _, codes in _by_length(batch.column(0).to_pylist()):
        yield min(m, LONGEST_SHARD), (codes * _powers(m)[:m]).sum(axis=1, dtype=np.uint64) + np.uint64(m)


def bloom_filters(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> tuple[Shards, np.ndarray]:
    """The filters of a vocabulary table, a shard per word length."""
    per_length = (words.groupBy(F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("length"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())
    shards = Shards({r.length: r.n for r in per_length}, filter_bytes)
    return shards, filters(words.select("word").mapInArrow(filled(shards, _hashes), filled.schema), shards)


def _probe(shards: Shards, table: np.ndarray, hashes: np.ndarray, length: int) -> np.ndarray:
    """Positions of the edits of ``length`` that their filter passes."""
    return probe(shards, table, hashes + np.uint64(length), min(length, LONGEST_SHARD))


def _edits(shards: Shards, table: np.ndarray, words: list[str]) -> Iterator[tuple[int, str]]:
    """(row, edit) for every generated edit that the filters pass."""
    symbols = [chr(int(c)) for c in ALPHABET]
    for m, rows, codes in _by_length(words):
        if m < MIN_LENGTH:
            continue
        powers = _powers(m)
        parts = codes * powers[:m]
        ends = np.cumsum(parts, axis=1)
        whole = ends[:, -1]
        for i in range(m):
            mine = codes[:, i]
            if m > MIN_LENGTH:
                fresh = np.arange(len(rows)) if i == 0 else np.flatnonzero(mine != codes[:, i - 1])
                shorter = (ends[:, i] - parts[:, i]) + (whole - ends[:, i]) * BASE_INVERSE
                for r in fresh[_probe(shards, table, shorter[fresh], m - 1)]:
                    word = words[rows[r]]
                    yield int(rows[r]), word[:i] + word[i + 1:]
            larger = ALPHABET[None, :] > mine[:, None]
            at, symbol = np.nonzero(larger)
            replaced = (whole - parts[:, i])[at] + ALPHABET[symbol] * powers[i]
            for k in _probe(shards, table, replaced, m):
                word = words[rows[at[k]]]
                yield int(rows[at[k]]), word[:i] + symbols[symbol[k]] + word[i + 1:]


def _probed(filters):
    def run(batches):
        shards, table = filters.value
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            rows, edits, chars = [], [], 0

            def found():
                return pa.RecordBatch.from_pydict({
                    "word": pa.array([words[r] for r in rows], pa.string()),
                    "n": counts.take(pa.array(rows, pa.int64())), "near": pa.array(edits, pa.string())})

            for row, edit in _edits(shards, table, words):
                rows.append(row)
                edits.append(edit)
                chars += len(edit)
                if chars > SLICE:
                    yield found()
                    rows, edits, chars = [], [], 0
            if rows:
                yield found()
    return run


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of near words of a vocabulary table, both ways round."""
    spark = words.sparkSession
    filters = spark.sparkContext.broadcast(bloom_filters(words, filter_bytes))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    edits = (words.repartition(tasks, "word")
             .mapInArrow(_probed(filters), "word string, n long, near string"))
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = written(edits.join(known, "near").select("word", "n", "near", "near_n"), "near-pairs")
    return pairs.unionByName(pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
        F.col("n").alias("near_n")))


def roots(forms: DataFrame, largest: int) -> DataFrame:
    """(word, root) for words that have a form; ``largest`` is the largest count of a word."""
    steps, n = 0, MIN_COUNT
    while n * RATIO <= largest:
        n, steps = n * RATIO, steps + 1
    found = forms.select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:
        found = written(found, "roots")
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = found.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        reach *= 2
    return found


def variants(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the documents."""
    words = written(vocabulary(docs), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_pairs(words, filter_bytes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best)
    strong = -F.col("best.less") >= F.lit(RATIO) * F.col("n")
    judged = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n")), "spelling-forms")
    largest = judged.agg(F.max("n")).first()[0] or 0
    ends = roots(judged.filter(F.col("form").isNotNull()), largest)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
