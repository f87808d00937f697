"""Phrase collocation mining with Rabin-Karp fingerprints.

Each scan hashes its texts in numpy: prefix polynomials over the bytes give the hash of every
word, prefix polynomials over those the fingerprint of every n-gram. Tasks count the fingerprints they meet, with the lowest
document that holds them as occurrence pointer, and a shuffle sums both. n-grams are counted level
by level: one is counted only if all its parts of the level before were frequent. The frequent
fingerprints of a level go into a blocked Bloom filter of bounded size (``FILTER_BYTES``), which is
all that is broadcast; it has no false negatives, so nothing frequent is missed at any size, and
false positives only cost some rows. Every occurrence carries a second, independent digest of its
text and is counted by both, so texts whose fingerprints collide are counted apart. A last scan follows the
pointers of the frequent fingerprints and spells them out; fingerprint and digest of that text are
joined to the counts, so each count meets the text that it belongs to.

Pieces, words, scores and cuts are those of the query's contract; products run in decimals of
38 digits. The report keeps the first ``TOP`` phrases of each language.

Defined cases: a null or empty text has no words; a null lang is ``und``; repeated rows and
repeated ids count as often as they occur; an empty table gives no rows; other columns are kept
out. A long text is handled in slices; n-grams across a cut are counted once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.bloom import FILTER_BYTES, Shards, filled, filters, mix, probe
from podium.llm.common import written

LONGEST, MIN_COUNT, TOP = 5, 100, 2000
LEVELS = ((1, 2), (3,), (4, 5))  # n-gram lengths counted per scan
SLICE = 1 << 20  # bytes of text handled at once
GIANT = 1 << 16  # words of more bytes are handled by their digest
ENTRIES = 1_000_000  # counters kept by a task
NO_DOC = (1 << 63) - 1
# (hashes of bytes, base, its inverse) of two independent polynomials modulo 2^64
SIDES = tuple((mix(np.arange(first, first + 256, dtype=np.uint64)), np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
              for first, base in ((1, 0xD6E8FEB86659FD93), (1001, 0xA0761D6478BD642F)))
BLANK, STOP = b" ", b"."
_MAP = bytes(STOP[0] if c in b".,;:!?\n\x0b\x0c\r" else BLANK[0] if c == 9 else c for c in range(256))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    np.multiply.accumulate(out, out=out)
    return out


def normalised(text: bytes, giants: dict[bytes, bytes]) -> bytes:
    """Lower-cased text with blanks for white space and STOP between pieces. A word above GIANT
    bytes becomes 0xFF, which no text holds, and its digest; ``giants`` keeps the word."""
    text = text.lower().translate(_MAP)  # bytes.lower changes A-Z only

    def digest(match: re.Match) -> bytes:
        word = b"\xff" + xxhash.xxh3_128_hexdigest(match[0]).encode()
        giants[word] = match[0]
        return word

    return re.sub(rb"[^ .]{%d,}" % (GIANT + 1), digest, text) if len(text) > GIANT else text


def _context(text: bytes, at: int) -> int:
    """Start of the LONGEST - 1 words before ``at``, or of those that the piece has."""
    for _ in range(LONGEST - 1):
        end = at
        while end and text[end - 1] == BLANK[0]:
            end = max(text[:end].rfind(BLANK * 2, max(0, end - 2)), end - 1)
        if end == 0 or text[end - 1] == STOP[0]:
            return end
        at = max(text.rfind(BLANK, 0, end), text.rfind(STOP, 0, end)) + 1
    return at


def slices(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(part, fresh): parts of a normalised text, cut between words; the bytes before ``fresh`` repeat the
    last words of the part before, so that n-grams across the cut are seen."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > SLICE:
            cuts = [c for c in (text.find(BLANK, start + SLICE), text.find(STOP, start + SLICE)) if c >= 0]
            end = min(cuts, default=end)
        low = _context(text, start) if start else 0
        yield text[low:end], start - low
        start = end


class Grams:
    """n-grams of one block of normalised parts of one language."""

    def __init__(self, lang: str, parts: list[bytes], fresh: list[int], docs: list[int]):
        self.data = STOP.join([b"", *parts])
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        first = np.cumsum(sizes) - sizes + 1
        data = np.frombuffer(self.data, np.uint8)
        stop = data == STOP[0]
        edge = np.diff((~stop & (data != BLANK[0])).view(np.int8), prepend=0, append=0)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(stop, dtype=np.int32)[self.starts]
        part = np.searchsorted(first, self.starts, side="right") - 1
        self.fresh = self.starts >= (first + np.array(fresh, np.int64))[part]
        self.docs = np.array(docs, np.int64)[part]
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(lang))
        self.sides = [self._side(data, symbols, base, inverse) for symbols, base, inverse in SIDES]

    def _side(self, data: np.ndarray, symbols, base, inverse) -> tuple[np.ndarray, np.ndarray]:
        """Prefix polynomial over the words' hashes, which come from one over the bytes."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(symbols[data] * _powers(base, len(data)), dtype=np.uint64, out=sums[1:])
        back = _powers(inverse, len(data) + 1)
        words = mix((sums[self.ends] - sums[self.starts]) * back[self.starts])
        n = len(words)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _powers(base, n), dtype=np.uint64, out=prefix[1:])
        return prefix, back[:n]

    def whole(self, n: int) -> np.ndarray:
        """Start of every n-gram that lies in one piece and is new in this block."""
        last = len(self.starts) - n + 1
        if last < 1:
            return np.zeros(0, np.int64)
        return np.flatnonzero((self.piece[n - 1:] == self.piece[:last]) & self.fresh[n - 1:])

    def prints(self, at: np.ndarray, n: int, side: int = 0) -> np.ndarray:
        """Fingerprints of n-grams; side 1 gives independent ones, their digests."""
        prefix, back = self.sides[side]
        x = (prefix[at + n] - prefix[at]) * back[at]
        return mix((x ^ self.seed) + np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64)))

    def covered(self, at: np.ndarray, n: int, part: int, gate) -> np.ndarray:
        """The n-grams of ``at`` all of whose parts of length ``part`` pass the gate."""
        if len(at) == 0:
            return at
        inside = np.flatnonzero(self.piece[part - 1:] == self.piece[:len(self.piece) - part + 1])
        passed = np.zeros(len(self.starts) + 1, np.int64)
        passed[inside[probe(*gate, self.prints(inside, part), 0)] + 1] = 1
        passed = np.cumsum(passed)
        return at[passed[at + n - part + 1] - passed[at] == n - part + 1]

    def text(self, at: int, n: int, giants: dict[bytes, bytes]) -> bytes:
        words = self.data[self.starts[at]:self.ends[at + n - 1]].split()
        return BLANK.join(giants[w] if w[:1] == b"\xff" else w for w in words)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Grams, dict[bytes, bytes]]]:
    """(lang, grams, giants) of bounded blocks of text of one language."""
    open_: dict[str, list[tuple[bytes, int, int]]] = {}
    sizes: Counter = Counter()
    giants: dict[bytes, bytes] = {}

    def closed(lang):
        del sizes[lang]
        return lang, Grams(lang, *map(list, zip(*open_.pop(lang)))), giants

    for batch in batches:
        for doc_id, text, lang in zip(*(batch.column(i) for i in range(3))):
            doc, lang = doc_id.as_py(), lang.as_py()
            text = normalised(text.as_py() or b"", giants)
            for part, fresh in slices(text):
                open_.setdefault(lang, []).append((part, fresh, NO_DOC if doc is None else doc))
                sizes[lang] += len(part)
                if sizes[lang] > SLICE:
                    yield closed(lang)
            if sizes.total() > 4 * SLICE or giants:
                yield from [closed(x) for x in list(open_)]
                giants.clear()
    yield from [closed(x) for x in list(open_)]


def _summed(prints, digests, counts, docs):
    """Neighbours of one fingerprint and digest as one row: summed count, lowest document."""
    order = np.argsort(prints, kind="stable")
    prints, digests, counts, docs = prints[order], digests[order], counts[order], docs[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (digests[1:] != digests[:-1])
    first = np.flatnonzero(new)
    return prints[first], digests[first], np.add.reduceat(counts, first), np.minimum.reduceat(docs, first)


def _counted(sizes: tuple[int, ...], part: int | None, gates):
    """Counts of the fingerprints of n-grams of ``sizes``; with gates, only covered ones."""
    def run(batches):
        kept, total = [], 0
        for _, grams, _ in _blocks(batches):
            for n in sizes:
                at = grams.whole(n)
                if part:
                    at = grams.covered(at, n, part, gates.value)
                if len(at):
                    found = grams.prints(at, n), grams.prints(at, n, 1), np.ones(len(at), np.int64), grams.docs[at]
                    kept.append(_summed(*found) if n == 1 else found)  # words repeat within a block
                    total += len(kept[-1][0])
            if total > ENTRIES:
                kept = [_summed(*map(np.concatenate, zip(*kept)))]
                total = len(kept[0][0])
                if total > ENTRIES // 2:
                    yield _batch(*kept[0])
                    kept, total = [], 0
        if kept:
            yield _batch(*_summed(*map(np.concatenate, zip(*kept))))
    return run


def _batch(prints, digests, counts, docs) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"print": prints.view(np.int64), "digest": digests.view(np.int64),
                                       "a": counts, "doc": docs})


def _pointer(prints: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return mix(prints ^ mix(docs.view(np.uint64)))


def _spelled(gates):
    """(print, digest, lang, n, phrase, words): the text of each frequent fingerprint where its
    pointer leads, and with n 0 the number of words of each language."""
    def run(batches):
        words: Counter = Counter()
        for lang, grams, giants in _blocks(batches):
            words[lang] += len(grams.whole(1))
            for n in range(1, LONGEST + 1):
                at = grams.whole(n)
                prints = grams.prints(at, n)
                hits = probe(*gates.value, _pointer(prints, grams.docs[at]), 0)
                hits = hits[np.unique(prints[hits], return_index=True)[1]] if len(hits) else hits
                if len(hits):
                    at = at[hits]
                    yield pa.RecordBatch.from_pydict({
                        "print": prints[hits].view(np.int64), "digest": grams.prints(at, n, 1).view(np.int64),
                        "lang": pa.array([lang] * len(at), pa.string()), "n": pa.array(np.full(len(at), n, np.int32)),
                        "phrase": pa.array([grams.text(k, n, giants) for k in at.tolist()], pa.binary()).cast(pa.string()),
                        "words": np.zeros(len(at), np.int64)})
        if words:
            k = len(words)
            yield pa.RecordBatch.from_pydict({
                "print": np.zeros(k, np.int64), "digest": np.zeros(k, np.int64), "lang": pa.array(list(words), pa.string()),
                "n": pa.array(np.zeros(k, np.int32)), "phrase": pa.array([""] * k, pa.string()),
                "words": pa.array(list(words.values()), pa.int64())})
    return run


def _gate(prints: DataFrame, filter_bytes: int, pointers: bool = False):
    """Broadcast Bloom filter of a table of fingerprints, or of (fingerprint, document) pairs; at most ``filter_bytes``."""
    shards = Shards({0: prints.count()}, filter_bytes)

    def hashes(batch):
        own, docs = (batch.column(i).to_numpy() for i in range(2))
        yield 0, _pointer(own.view(np.uint64), docs) if pointers else own.view(np.uint64)

    return prints.sparkSession.sparkContext.broadcast(
        (shards, filters(prints.select("print", "doc").mapInArrow(filled(shards, hashes), filled.schema), shards)))


def frequent_phrases(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(lang, n, phrase, a, doc): phrases of 1 to 5 words that occur MIN_COUNT times or more,
    and the number of words of each language (n 0)."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"),
                        F.coalesce("lang", F.lit("und")).alias("lang"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent, gate = None, None
    for sizes, part in zip(LEVELS, [None, *(max(s) for s in LEVELS)]):
        # tasks send a fingerprint a few times at most, so a second partial sum would only cost memory
        counts = texts.mapInArrow(_counted(sizes, part, gate), "print long, digest long, a long, doc long").repartition(parts, "print")
        found = written(counts.groupBy("print", "digest").agg(F.sum("a").alias("a"), F.min("doc").alias("doc"))
                        .filter(F.col("a") >= MIN_COUNT), "frequent-prints")
        if sizes != LEVELS[-1]:
            gate = _gate(found, filter_bytes)
        frequent = found if frequent is None else frequent.unionByName(found)
    spelled = written(texts.mapInArrow(_spelled(_gate(frequent, filter_bytes, pointers=True)),
                                       "print long, digest long, lang string, n int, phrase string, words long"), "spelled")
    totals = spelled.filter(F.col("n") == 0).groupBy("lang").agg(F.sum("words").alias("a")).select(
        "lang", F.lit(0).alias("n"), F.lit("").alias("phrase"), "a", F.lit(NO_DOC).alias("doc"))
    texts = spelled.filter(F.col("n") > 0).select("print", "digest", "lang", "n", "phrase").distinct()
    return texts.join(frequent, ["print", "digest"]).select("lang", "n", "phrase", "a", "doc").unionByName(totals)


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates that no longer one replaces, with the lowest score of their cuts."""
    words = F.split("phrase", " ")
    candidates = phrases.filter(F.col("n") >= 2).withColumnRenamed("n", "size")
    cuts = (candidates.select("lang", "phrase", "size", "a", "doc", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .withColumns({"first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
                          "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ")}))
    part = phrases.filter((F.col("n") >= 1) & (F.col("n") < LONGEST))
    left = part.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    # a row per language: written, so that the planner knows its size
    total = written(phrases.filter(F.col("n") == 0).select("lang", F.col("a").alias("n")), "words-per-language")
    d = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    cuts = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(total, "lang")
            .withColumns({"over": d["a"] * d["n"] * F.lit(1000).cast("decimal(4,0)"), "under": d["l"] * d["r"]})
            .withColumn("score", F.expr("over div under")))
    best = cuts.groupBy("lang", "phrase", "size", "a", "n", "doc").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    longer = candidates.filter(F.col("size") >= 3)
    inner = F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "),
                    F.array_join(F.slice(words, F.lit(2), F.col("size")), " "))
    # a longer phrase is never more frequent, so one that replaces it is equally frequent, and
    # so are all phrases between the two: those of one word more suffice
    replaced = longer.select("lang", F.explode(inner).alias("phrase"), "a")
    return (best.join(replaced, ["lang", "phrase", "a"], "left_anti")
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", "best.k", "doc"))


def collocations(docs: DataFrame, top: int = TOP, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score; cut and first_doc."""
    ranked = scored(written(frequent_phrases(docs, filter_bytes), "frequent-phrases"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
                    F.col("k").alias("cut"), F.when(F.col("doc") != NO_DOC, F.col("doc")).alias("first_doc")))
