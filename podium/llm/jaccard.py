"""N-gram Jaccard join by MinHash banding.

Texts are sets of hashed 5-word n-grams. MinHash signatures are cut into bands, with band and
row counts chosen for the target recall at the threshold. Copies (equal sets) are folded to
one representative first, so a group of copies costs one row. Representatives meet in the
buckets of a shuffle on band hashes. A bucket of more than ``BLOCK`` members is dealt into
blocks, and each pair of blocks is one small group, so no bucket is gathered in one task. All
pairs of a group are verified on their full n-gram sets with array arithmetic inside the
task; a pair of several common bands counts in the first of them. A group returns one row per
linked member: its links and the lowest member it hangs together with there. No pair rows are
made, and no link is dropped.

Classes are the connected components of the links, found by rounds of joins over
checkpointed tables.

Defined cases: a text without a word has no n-gram and stays alone; fewer than five words make
one n-gram of them all; rows that share a doc_id are one document with the lowest n-gram set, a
row without a doc_id is left out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import PieceTable, blocks, releasing, written

NGRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9998, 128
BLOCK = 192
CHARS, MEMO = 500_000, 150_000  # characters whose n-grams are made at once, words a task remembers
_WORD = re.compile(r"\w+")
_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL,
                 hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band that reach the recall within the hash budget."""
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= hashes:
            best = (bands, rows)
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(pieces: list[str]) -> list[list[int]]:
    return [[xxhash.xxh3_64_intdigest(w) for w in _WORD.findall(p)] for p in pieces]


class Shingler:
    """Sorted distinct n-gram hashes of texts."""

    def __init__(self, ngram: int = NGRAM):
        self.ngram, self.memo = ngram, PieceTable(_word_hashes, np.uint64, MEMO)

    def sets(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row numbers, set sizes, concatenated sets) per block; a row lies in one block."""
        n, held, last = self.ngram, [], None

        def close(runs: list[tuple[int, np.ndarray]]):
            rows = np.array([r for r, _ in runs], np.int64)
            words = np.concatenate([w for _, w in runs])
            sizes = np.array([len(w) for _, w in runs], np.int64)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            grams = np.maximum(sizes - n + 1, np.minimum(sizes, 1))
            owner = np.repeat(np.arange(len(rows)), grams)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(grams) - grams, grams) + starts[owner]
            state = np.zeros(len(owner), np.uint64)
            for j in range(n):
                inside = at + j < ends[owner]
                word = np.where(inside, words[np.minimum(at + j, len(words) - 1)], _U(0))
                state = _mix(state * _P + word)
            order = np.lexsort((state, owner))
            state, owner = state[order], owner[order]
            first = np.ones(len(state), bool)
            first[1:] = (state[1:] != state[:-1]) | (owner[1:] != owner[:-1])
            return rows, np.bincount(owner[first], minlength=len(rows)), state[first]

        for part, rows in blocks(texts, CHARS):
            values, counts = self.memo.flat([x.lower().split() for x in part])
            for row, words in zip(rows, np.split(values, np.cumsum(counts)[:-1])):
                if held and row == last:
                    held[-1] = (row, np.concatenate([held[-1][1], words]))
                else:
                    held.append((row, words))
                last = row
            # the last row may go on in the next block
            if len(held) > 1:
                yield close(held[:-1])
                held = held[-1:]
        if held:
            yield close(held)


def signatures(values: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (sets x bands) of concatenated sets, all of them non-empty."""
    rng = np.random.default_rng(11)
    salts = rng.integers(1, 1 << 63, (bands * rows, 2), dtype=np.uint64) | _U(1)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros((len(sizes), bands), np.uint64)
    for b in range(bands):
        state = np.full(len(sizes), b + 1, np.uint64)
        for r in range(rows):
            a, c = salts[b * rows + r]
            lowest = np.minimum.reduceat((values * a + c) >> _U(20), starts)
            state = _mix(state * _P + lowest)
        out[:, b] = state
    return out


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, set_key, n_grams, bands) per document; set_key is null without a word."""
    def sign(batches):
        shingler = Shingler()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
            n = len(texts)
            keys, sizes = [None] * n, np.zeros(n, np.int64)
            found: list = [None] * n
            for owner, counts, values in shingler.sets(texts):
                some = counts > 0
                if some.any():
                    hashes = signatures(values, counts[some], bands, rows).view(np.int64)
                    own = np.split(values, np.cumsum(counts[some])[:-1])
                    for i, row in enumerate(owner[some].tolist()):
                        keys[row] = xxhash.xxh3_128_digest(own[i].tobytes())
                        found[row] = hashes[i]
                sizes[owner] = counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes),
                 pa.array(found, pa.list_(pa.int64()))], ["doc_id", "set_key", "n_grams", "bands"])

    return docs.mapInArrow(releasing(sign), "doc_id long, set_key binary, n_grams long, bands array<long>")


def _buckets(reps: DataFrame) -> DataFrame:
    """(band, hash, members) of the buckets with several members; of buckets with the same
    members only that of the first band is kept."""
    rows = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    mark = F.xxhash64("rep")
    sums = (rows.groupBy("band", "hash")
            .agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("low"), F.max("rep").alias("high"),
                 F.sum(mark.cast("decimal(20,0)")).alias("sum_"), F.bit_xor(mark).alias("xor_"))
            .where("members > 1"))
    return (sums.groupBy("members", "low", "high", "sum_", "xor_")
            .agg(F.min(F.struct("band", "hash")).alias("first"))
            .select("first.band", "first.hash", "members"))


def _dealt(reps: DataFrame, buckets: DataFrame, block: int) -> DataFrame:
    """Members of the buckets, once per pair of blocks that holds their block."""
    rows = reps.select("rep", "set_key", "bands", F.posexplode("bands").alias("band", "hash"))
    parts = F.ceil(F.col("members") / block).cast("int")
    mine = F.pmod(F.xxhash64("rep", "band"), F.col("parts")).cast("int")
    return (rows.join(buckets, ["band", "hash"])
            .withColumn("parts", parts).withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("rep", "set_key", "bands", "mine", F.xxhash64(
                "band", "hash", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"),
                "band", (F.col("mine") != F.col("other")).alias("cross")))


def _links(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs whose Jaccard similarity reaches the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    common = np.zeros((n, n), np.int64)
    if n == 2:
        common[0, 1] = common[1, 0] = np.intersect1d(sets[0], sets[1], assume_unique=True).size
    else:
        owner = np.repeat(np.arange(n), sizes)
        values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = counts[inverse] > 1
        _, column = np.unique(inverse[shared], return_inverse=True)
        owner = owner[shared]
        width, step = int(column.max(initial=-1)) + 1, 4096
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for lo in range(0, width, step):
            a, b = np.searchsorted(column, [lo, lo + step])
            grid = np.zeros((n, min(step, width - lo)), np.float32)
            grid[owner[a:b], column[a:b] - lo] = 1
            common += np.rint(grid @ grid.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def verify_group(reps: np.ndarray, bands: np.ndarray, mine: np.ndarray, cross: bool, band: int,
                 sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, ...]:
    """(member, links, lowest member of its part) for the linked members of one group."""
    linked = _links(sets, threshold)
    if cross:  # pairs within a block belong to another group
        linked &= mine[:, None] != mine[None, :]
    for earlier in range(band):
        linked &= bands[:, None, earlier] != bands[None, :, earlier]
    degree = linked.sum(axis=1)
    root = np.arange(len(reps))
    order = np.argsort(reps, kind="stable")
    for i in order:  # depth-first from the lowest member of each part
        if root[i] != i or not degree[i]:
            continue
        stack = [i]
        while stack:
            near = np.flatnonzero(linked[stack.pop()] & (root == np.arange(len(reps)))
                                  & (np.arange(len(reps)) != i))
            root[near] = i
            stack.extend(near.tolist())
    some = degree > 0
    return reps[some], degree[some], reps[root[some]]


def _verified(dealt: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(src, links, dst) of all groups; ``texts`` holds (rep, text) of the candidates."""
    spark = dealt.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def to_sets(batches):
        shingler = Shingler()
        for batch in batches:
            found = [b""] * batch.num_rows
            for owner, counts, values in shingler.sets(batch.column("text").to_pylist()):
                for row, own in zip(owner.tolist(), np.split(values, np.cumsum(counts)[:-1])):
                    found[row] = own.tobytes()
            keys = [xxhash.xxh3_128_digest(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array(keys, pa.binary()), pa.array(found, pa.binary())],
                ["rep", "set_key", "grams"])

    sets = written(texts.mapInArrow(releasing(to_sets), "rep long, set_key binary, grams binary"), "jaccard-sets")

    def verify(batches):
        held: list[dict] = []

        def close(group: list[dict]):
            if len(group) < 2 or (group[0]["cross"] and len({r["mine"] for r in group}) < 2):
                return None
            return verify_group(
                np.array([r["rep"] for r in group], np.int64),
                np.array([r["bands"] for r in group], np.int64),
                np.array([r["mine"] for r in group]), group[0]["cross"], group[0]["band"],
                [np.frombuffer(r["grams"], np.uint64) for r in group], threshold)

        def emit(found):
            found = [f for f in found if f is not None and len(f[0])]
            columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              ["src", "links", "dst"])

        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if held and held[-1]["key"] != row["key"]:
                        found.append(close(held))
                        held = []
                    if not held or held[-1]["rep"] != row["rep"]:  # else a repeated row
                        held.append(row)
            yield emit(found)
        if held:
            yield emit([close(held)])

    return (dealt.join(sets, ["rep", "set_key"]).repartition(parts, "key").sortWithinPartitions("key", "rep")
            .select("rep", "bands", "mine", "key", "band", "cross", "grams")
            .mapInArrow(releasing(verify), "src long, links long, dst long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, class_id): the lowest node of each connected component of (src, dst) edges.

    Each round every node takes the lowest label among itself and its neighbours, then the
    label of that label; edges move to the labels and inner ones go. Rounds end when no edge
    is left, after about log(longest path) rounds.
    """
    edges = edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).where("a <> b")
    edges = written(edges.distinct(), "component-edges")
    trail: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        hop = both.groupBy("node").agg(F.min("near").alias("near")).select(
            "node", F.least("node", "near").alias("label"))
        hop = written(hop, "component-hop")
        up = hop.select(F.col("node").alias("label"), F.col("label").alias("label2"))
        hop = written(hop.join(up, "label").select("node", F.col("label2").alias("label")), "component-step")
        trail.append(hop)
        left = hop.select(F.col("node").alias("a"), F.col("label").alias("a2"))
        right = hop.select(F.col("node").alias("b"), F.col("label").alias("b2"))
        moved = edges.join(left, "a").join(right, "b")
        edges = written(moved.select(F.greatest("a2", "b2").alias("a"), F.least("a2", "b2").alias("b"))
                        .where("a <> b").distinct(), "component-edges")
    if not trail:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("class_id"))
    labels = trail[-1]
    for earlier in reversed(trail[:-1]):  # the labels of a round are nodes of the next
        later = labels.select(F.col("node").alias("label"), F.col("label").alias("last"))
        labels = earlier.join(later, "label", "left").select(
            "node", F.coalesce("last", "label").alias("label"))
    return labels.select("node", F.col("label").alias("class_id"))


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
         block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, class_id, copy_id, n_links, n_copies, n_grams.

    ``copy_id`` is the lowest document with the same n-grams, ``n_links`` the number of other
    n-gram sets that reach the threshold, ``class_id`` the lowest document of the class.
    """
    bands, rows = choose_bands(threshold, recall)
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).where(
        "doc_id IS NOT NULL")
    lowest = F.min(F.struct("set_key", "n_grams", "bands")).alias("low")
    signed = written(_signed(one, bands, rows).groupBy("doc_id").agg(lowest).select("doc_id", "low.*"),
                     "jaccard-signatures")
    reps = written(signed.where("set_key IS NOT NULL").groupBy("set_key", "bands").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies")), "jaccard-representatives")
    buckets = written(_buckets(reps), "jaccard-buckets")
    dealt = written(_dealt(reps, buckets, block), "jaccard-groups")
    wanted = written(reps.select("rep", "bands").select("rep", F.posexplode("bands").alias("band", "hash"))
                     .join(buckets, ["band", "hash"], "left_semi").select("rep").distinct(), "jaccard-candidates")
    texts = one.join(wanted, one["doc_id"] == wanted["rep"]).select("rep", "text")
    links = written(_verified(dealt, texts, threshold), "jaccard-links")
    degree = links.groupBy("src").agg(F.sum("links").alias("links"))
    classes = components(links.select("src", "dst"))
    facts = (reps.select("set_key", "rep", "n_copies")
             .join(degree, F.col("rep") == F.col("src"), "left").drop("src")
             .join(classes, F.col("rep") == F.col("node"), "left").drop("node"))
    return (signed.select("doc_id", "set_key", "n_grams").join(facts, "set_key", "left")
            .select("doc_id", F.coalesce("class_id", "rep", "doc_id").alias("class_id"),
                    F.coalesce("rep", "doc_id").alias("copy_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "n_grams"))


def clean(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document (the lowest doc_id) of each class; all columns are kept.

    Rows without a doc_id are no documents and stay.
    """
    found = join(docs, threshold)
    gone = written(found.where("doc_id <> class_id").select(F.col("doc_id").alias("gone")), "jaccard-gone")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
