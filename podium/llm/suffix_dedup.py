"""Removal of repeated byte strings: blockwise suffix sorting with a difference cover.

A byte goes if a string of ``LENGTH`` bytes that covers it starts at a second place of the corpus.
Sorting all suffixes of a corpus would shuffle every byte many times over. Here a suffix only
has to be told apart from others over ``LENGTH`` bytes, and a difference cover says which need it:
of any two places, some shift below ``PERIOD`` takes both to cover positions of their documents.
So two equal strings of ``LENGTH`` bytes hold two equal strings of ``DEPTH`` bytes at cover positions.

1. Sample: the suffixes at cover positions (8 of 57) are dealt into buckets by fingerprint and
   sorted one bucket at a time over ``DEPTH`` bytes. Only those that tie go on.
2. Ranks of the long ties: tied sample suffixes are sorted, one bucket at a time, with the
   ``PERIOD - 1`` bytes before and behind them. Where two agree on those too, all strings of ``LENGTH`` bytes that
   start up to ``PERIOD - 1`` bytes before the sample are equal as well: no suffix inside a long
   common passage is ever sorted itself.
3. The rest: where a class of tied samples has a member without such a partner (the ends of
   passages), all suffixes in reach of its members are dealt into buckets and sorted there.

Suffixes are ordered by fingerprints of the bytes compared (prefix polynomials modulo 2^64), not
by the bytes: only ties matter here. What is removed rests on 64 bits and a bucket number from an independent
fingerprint, so false ties stay improbable as buckets grow in number with the input. A bucket answers each
suffix with one bit, in the order sent.

Texts are stored once, about ``BLOCK`` bytes to a row, in a table bucketed by row number, so the
answers are joined to them without another shuffle of texts. A row sends a suffix at most twice per
``UNIT``, so a passage that all documents share is no hot key. Memory follows the bucket and the unit,
besides the whole bytes of one document.

Defined cases: a null text is empty; repeated rows and ids are documents of their own (all of
their strings repeat); texts shorter than ``LENGTH`` bytes stay whole; an empty table gives no
rows; other columns are kept out.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.bloom import mix
from podium.llm.common import shared_path, written

LENGTH = 200
# fixed values: a perfect difference set, every difference modulo PERIOD occurs once
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
DEPTH = LENGTH - PERIOD + 1
BLOCK, BLOCK_DOCS = 4 << 20, 20_000
UNIT = 4 << 20  # bytes whose suffixes are dealt out together
CHUNK = 1 << 19  # bytes whose fingerprints are made together
BUCKET_SUFFIXES = 1 << 20
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
SYMBOLS = tuple(mix(np.arange(1 + 256 * i, 257 + 256 * i, dtype=np.uint64)) for i in range(2))
IN_COVER = np.isin(np.arange(PERIOD), COVER)
ANSWERS = "block long, phase int, unit int, bucket int, tied binary, mixed binary"


@lru_cache(maxsize=4)
def _powers(which: int, n: int, inverse: bool) -> np.ndarray:
    base = pow(int(BASES[which]), -1 if inverse else 1, 1 << 64)
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    np.multiply.accumulate(out, out=out)
    return out


class Block:
    """Documents of one row, joined; positions count through all of them."""

    def __init__(self, sizes: np.ndarray, data: bytes):
        self.data = data
        self.bytes = np.frombuffer(data, np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.units = range(-(-len(data) // UNIT))
        self._sums: tuple = (None, None)

    def span(self, unit: int) -> tuple[int, int]:
        return unit * UNIT, min(len(self.data), (unit + 1) * UNIT)

    def bounds(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        doc = np.searchsorted(self.ends, at, side="right")
        return self.starts[doc], self.ends[doc]

    def prints(self, which: int, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the ``n`` bytes at each place of ``at`` (sorted), chunk by chunk."""
        out = np.empty(len(at), np.uint64)
        size = CHUNK + LENGTH + PERIOD
        for chunk in range(int(at[0]) // CHUNK, int(at[-1]) // CHUNK + 1) if len(at) else ():
            low = chunk * CHUNK
            part = slice(*np.searchsorted(at, (low, low + CHUNK)))
            if part.start == part.stop:
                continue
            if self._sums[0] != (chunk, which):
                data = self.bytes[low:low + size]
                sums = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(SYMBOLS[which][data] * _powers(which, size, False)[:len(data)], dtype=np.uint64, out=sums[1:])
                self._sums = (chunk, which), sums
            sums, own = self._sums[1], at[part] - low
            out[part] = mix((sums[own + n] - sums[own]) * _powers(which, size, True)[own])
        return out

    def samples(self, unit: int) -> np.ndarray:
        """Cover positions of the unit with DEPTH bytes of their document behind them."""
        found = [np.zeros(0, np.int64)]
        for first in range(*self.span(unit), CHUNK):
            last = min(first + CHUNK, self.span(unit)[1])
            docs = slice(np.searchsorted(self.ends, first, side="right"),
                         np.searchsorted(self.ends, last - 1, side="right") + 1)
            starts, ends = self.starts[docs], self.ends[docs]
            sizes = np.minimum(ends, last) - np.maximum(starts, first)
            at = np.arange(first, last)
            found.append(at[IN_COVER[(at - np.repeat(starts, sizes)) % PERIOD] & (at + DEPTH <= np.repeat(ends, sizes))])
        return np.concatenate(found)


def _reach(at: np.ndarray, low: int, high: int) -> np.ndarray:
    """Places from ``low`` to before ``high`` that lie up to PERIOD - 1 before one of ``at`` (sorted)."""
    at = at[np.searchsorted(at, low):np.searchsorted(at, high + PERIOD - 1)]
    edge = np.zeros(high - low + 1, np.int32)
    np.add.at(edge, np.clip(at - PERIOD + 1 - low, 0, high - low), 1)
    np.add.at(edge, np.clip(at + 1 - low, 0, high - low), -1)
    return low + np.flatnonzero(np.cumsum(edge[:-1]) > 0)


class Deal:
    """Suffixes of a unit in the order in which they are sent: by bucket, each at most twice.

    ``key`` gives bucket and order; equal suffixes have equal ``key`` and ``name``.
    """

    def __init__(self, key: np.ndarray, name: np.ndarray | None, buckets: int):
        self.order = np.lexsort((name, key)) if name is not None else np.argsort(key, kind="stable")
        key = key[self.order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        if name is not None:
            new[1:] |= name[self.order][1:] != name[self.order][:-1]
        self.group = np.cumsum(new) - 1
        self.head = np.flatnonzero(new)
        self.sent = np.arange(len(key)) - self.head[self.group] < 2 if len(key) else new
        of = ((key[self.sent] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(of)) + 1
        self.bounds = np.concatenate([[0], cuts, [len(of)]]) if len(of) else np.zeros(1, np.int64)
        self.buckets = of[self.bounds[:-1]].astype(np.int64)

    def rows(self, *values: np.ndarray) -> list[tuple]:
        """(bucket, bytes of its part of each of ``values``)."""
        values = [v[self.order][self.sent] for v in values]
        return [(int(b), *(v[i:j].tobytes() for v in values))
                for b, i, j in zip(self.buckets, self.bounds[:-1], self.bounds[1:])]

    def answered(self, bits: dict[int, bytes]) -> np.ndarray:
        """The buckets' bits for all suffixes of the unit, those not sent included."""
        sent = np.zeros(int(self.bounds[-1]), bool)
        for b, i, j in zip(self.buckets, self.bounds[:-1], self.bounds[1:]):
            sent[i:j] = np.unpackbits(np.frombuffer(bits[int(b)], np.uint8), count=j - i)
        place = np.cumsum(self.sent) - 1
        out = np.zeros(len(self.order), bool)
        out[self.order] = sent[place[self.head]][self.group] if len(self.order) else False
        return out


class Search:
    """The three sorts over one block, as far as their answers are known.

    ``answers[phase, unit]`` maps a bucket to its (tied, mixed) bits.
    """

    def __init__(self, block: Block, buckets: int, answers: dict):
        self.block, self.buckets, self.answers = block, buckets, answers

    def _bits(self, phase: int, unit: int, which: int) -> dict[int, bytes]:
        return {b: x[which] for b, x in self.answers.get((phase, unit), {}).items()}

    def sample(self, unit: int) -> tuple[np.ndarray, np.ndarray, Deal]:
        at = self.block.samples(unit)
        key = self.block.prints(0, at, DEPTH)
        return at, key, Deal(key, None, self.buckets)

    def ranked(self, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Deal]:
        """Tied samples: place, key, fingerprint with their surroundings (0: not all in the document)."""
        at, key, deal = self.sample(unit)
        tied = deal.answered(self._bits(1, unit, 0))
        at, key = at[tied], key[tied]
        start, end = self.block.bounds(at)
        inside = (at - PERIOD + 1 >= start) & (at + LENGTH <= end)
        around = np.zeros(len(at), np.uint64)
        around[inside] = np.maximum(self.block.prints(1, at[inside] - PERIOD + 1, LENGTH + PERIOD - 1), np.uint64(1))
        return at, key, around, Deal(key, around, self.buckets)

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Samples whose surroundings tie, and those of a class in which some do not."""
        tied, mixed = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for unit in self.block.units:
            at, _, _, deal = self.ranked(unit)
            tied.append(at[deal.answered(self._bits(2, unit, 0))])
            mixed.append(at[deal.answered(self._bits(2, unit, 1))])
        return np.concatenate(tied), np.concatenate(mixed)

    def rest(self, unit: int, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, Deal]:
        at = _reach(mixed, *self.block.span(unit))
        start, end = self.block.bounds(at)
        at = at[at + LENGTH <= end]
        key = self.block.prints(1, at, LENGTH)
        name = self.block.prints(0, at, LENGTH)
        return at, name, Deal(key, name, self.buckets)

    def repeated(self) -> np.ndarray:
        """Starts of all strings of LENGTH bytes that start anywhere else too."""
        tied, mixed = self.classes()
        found = [np.zeros(0, np.int64)]
        for unit in self.block.units:
            at, _, deal = self.rest(unit, mixed)
            at = at[deal.answered(self._bits(3, unit, 0))]
            found.append(np.union1d(at, _reach(tied, *self.block.span(unit))))
        return np.concatenate(found)

    def send(self, phase: int) -> Iterator[tuple]:
        """(unit, bucket, names, surroundings) for a sort."""
        mixed = self.classes()[1] if phase == 3 else None
        for unit in self.block.units:
            if phase == 1:
                _, key, deal = self.sample(unit)
                rows = deal.rows(key.astype(np.uint32))
            elif phase == 2:
                _, key, around, deal = self.ranked(unit)
                rows = deal.rows(key.astype(np.uint32), around)
            else:
                _, name, deal = self.rest(unit, mixed)
                rows = deal.rows(name)
            for row in rows:
                yield (unit, *row, *([b""] if len(row) == 2 else []))


def _sorted_bucket(phase: int) -> Callable[[pa.Table], pa.Table]:
    """Sorts the suffixes of a bucket and answers each with its bits."""
    def run(table: pa.Table) -> pa.Table:
        parts = table.column("names").to_pylist()
        kind = np.uint64 if phase == 3 else np.uint32
        names = np.frombuffer(b"".join(parts), kind)
        sizes = [len(p) // kind().itemsize for p in parts]
        around = np.frombuffer(b"".join(table.column("around").to_pylist()), np.uint64) if phase == 2 else None
        order = np.lexsort((around, names)) if phase == 2 else np.argsort(names, kind="stable")
        ordered = names[order]
        new = np.ones(len(names), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        exact = new.copy()
        if phase == 2:
            exact[1:] |= around[order][1:] != around[order][:-1]
        several = np.bincount(np.cumsum(exact) - 1)[np.cumsum(exact) - 1] > 1
        tied, mixed = np.zeros(len(names), bool), np.zeros(len(names), bool)
        if phase == 2:
            several &= around[order] != 0
            of = np.cumsum(new) - 1
            mixed[order] = (np.bincount(of, weights=~several) > 0)[of]
        tied[order] = several
        cuts = np.cumsum(sizes)[:-1]
        n = table.num_rows
        return pa.table({
            "block": table.column("block"), "phase": pa.array(np.full(n, phase, np.int32)),
            "unit": table.column("unit"), "bucket": table.column("bucket"),
            "tied": pa.array([np.packbits(x).tobytes() for x in np.split(tied, cuts)], pa.binary()),
            "mixed": pa.array([np.packbits(x).tobytes() if phase == 2 else b"" for x in np.split(mixed, cuts)],
                              pa.binary())})
    return run


# --- Spark side ------------------------------------------------------------------------

def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about BLOCK bytes of documents (one document at least)."""
    number = TaskContext.get().partitionId() << 40
    pack = zstandard.ZstdCompressor(level=3)
    ids, sizes, texts, total = [], [], [], 0

    def row():
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "data": pa.array([pack.compress(b"".join(texts))], pa.binary())})

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or b""
            if ids and (total + len(text) > BLOCK or len(ids) >= BLOCK_DOCS):
                yield row()
                number += 1
                ids, sizes, texts, total = [], [], [], 0
            ids.append(doc_id.as_py())
            sizes.append(len(text))
            texts.append(text)
            total += len(text)
    if ids:
        yield row()


def _searches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[int, list, Search]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            answers: dict = {}
            for x in row.get("answers") or ():
                answers.setdefault((x["phase"], x["unit"]), {})[x["bucket"]] = x["tied"], x["mixed"]
            data = zstandard.ZstdDecompressor().decompress(row["data"])
            yield row["block"], row["ids"], Search(Block(np.array(row["sizes"], np.int64), data), buckets, answers)


def _sent(phase: int, buckets: int):
    def run(batches):
        for block, _, search in _searches(batches, buckets):
            rows: list[tuple] = []
            size = 0
            for row in search.send(phase):
                rows.append((block, *row))
                size += len(row[2]) + len(row[3])
                if size > 4 << 20:
                    yield _sent_rows(rows)
                    rows, size = [], 0
            if rows:
                yield _sent_rows(rows)
    return run


def _sent_rows(rows: list[tuple]) -> pa.RecordBatch:
    block, unit, bucket, names, around = zip(*rows)
    return pa.RecordBatch.from_pydict({
        "block": pa.array(block, pa.int64()), "unit": pa.array(unit, pa.int32()),
        "bucket": pa.array(bucket, pa.int32()), "names": pa.array(names, pa.binary()),
        "around": pa.array(around, pa.binary())})


def removed_spans(block: Block, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of the maximal runs of bytes that the strings at ``starts`` cover."""
    doc = np.searchsorted(block.ends, starts, side="right")
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > starts[:-1] + LENGTH) | (doc[1:] != doc[:-1])
    last = np.flatnonzero(np.append(new[1:], True)) if len(starts) else np.zeros(0, np.int64)
    return doc[new], starts[new], starts[last] + LENGTH


def _kept(buckets: int):
    def run(batches):
        for _, ids, search in _searches(batches, buckets):
            block = search.block
            doc, first, last = removed_spans(block, search.repeated())
            spans = np.bincount(doc, minlength=len(ids))
            removed = np.bincount(doc, weights=last - first, minlength=len(ids)).astype(np.int64)
            at, digests = 0, []
            view = memoryview(block.data)
            for i in range(len(ids)):
                digest, here = hashlib.sha256(), int(block.starts[i])
                for _ in range(int(spans[i])):
                    digest.update(view[here:int(first[at])])
                    here = int(last[at])
                    at += 1
                digest.update(view[here:int(block.ends[i])])
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n_bytes": block.ends - block.starts, "n_removed": removed,
                "n_spans": spans.astype(np.int64), "kept_sha256": pa.array(digests, pa.string())})
    return run


def _stored(docs: DataFrame, parts: int) -> tuple[DataFrame, str]:
    """The blocks as a table bucketed by block (and its name): joins on it move no text."""
    spark = docs.sparkSession
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        _blocked, "block long, ids array<long>, sizes array<long>, data binary")
    (rows.repartition(parts, "block").write.option("compression", "uncompressed")
     .option("path", shared_path(spark, name)).bucketBy(parts, "block").sortBy("block").saveAsTable(name))
    return spark.table(name), name


def dedupe(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    spark: SparkSession = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(parts, total * len(COVER) // PERIOD // BUCKET_SUFFIXES)
    blocks, name = _stored(docs, parts)
    try:
        answers, known = None, blocks
        for phase in (1, 2, 3):
            sent = known.mapInArrow(_sent(phase, buckets), "block long, unit int, bucket int, names binary, around binary")
            found = written(sent.groupBy("bucket").applyInArrow(_sorted_bucket(phase), ANSWERS), "suffix-answers")
            answers = found if answers is None else answers.unionByName(found)
            per_block = answers.groupBy("block").agg(
                F.collect_list(F.struct("phase", "unit", "bucket", "tied", "mixed")).alias("answers"))
            known = blocks.join(per_block, "block", "left")
        return written(known.mapInArrow(_kept(buckets),
                                        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"),
                       "suffix-dedup")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
