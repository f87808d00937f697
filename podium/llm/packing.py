"""Mixture-controlled packing of token ids into fixed-length sequences.

Each source is a queue of ids; a granule is ``quantum`` consecutive ids of one queue. Deficit
round-robin serves the queue whose credit is due next: a queue earns credit in proportion to
its target weight, spends one granule per turn and keeps what is left. Its k-th granule is
due when its credit reaches k + 1/2 granules, at time (2k + 1) / weight, so the number of
granules served before it follows from the queue sizes alone. Every document therefore
computes its own places without seeing the others: deficits carry over all windows and
partitions, and no queue, window or source is gathered in one task. Queues that run dry drop
out and the rest keep their proportions. Last come the incomplete granules of the queues.

Ids are written once to the shared folder; the per-queue offsets come from one small row per
partition and source.

Defined cases: a null text is empty, an empty text holds only the end id (or makes no piece
without one); a null source is a queue of its own; repeated rows are packed once per row; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import releasing, row_slices, written
from podium.llm.tokens import DEFAULT_VOCABULARY, encoder

LENGTH = 1024
QUANTUM = 128
_IDS_SCHEMA = "doc_id long, source string, part int, before long, n_tokens long, ids binary"


def tokenized(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY,
              end_id: int | None = 0) -> DataFrame:
    """Ids per document, with its place in its source's run within the partition."""
    def encode(batches):
        tokens, part = encoder(vocabulary), TaskContext.get().partitionId()
        runs: dict[str | None, int] = {}
        for batch in row_slices(batches, "text"):
            n = batch.num_rows
            ids, counts = tokens.encode(batch.column("text").to_pylist(), n, end_id)
            sources = batch.column("source").to_pylist()
            before = np.zeros(n, np.int64)
            for i, (source, count) in enumerate(zip(sources, counts)):
                before[i] = runs.get(source, 0)
                runs[source] = int(before[i] + count)
            raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts) * 4
            blobs = [raw[e - 4 * c:e] for e, c in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"),
                 pa.array(np.full(n, part), pa.int32()), pa.array(before), pa.array(counts),
                 pa.array(blobs, pa.binary())],
                ["doc_id", "source", "part", "before", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").alias("text"),
                       F.col("source").cast("string").alias("source")).mapInArrow(releasing(encode), _IDS_SCHEMA)


class Schedule:
    """Closed form of the deficit round-robin order over queues of given sizes."""

    def __init__(self, totals: list[int], weights: list[int] | None = None,
                 quantum: int = QUANTUM):
        self.quantum = quantum
        self.full = [t // quantum for t in totals]
        weights = [max(1, w) for w in (weights or self.full)]
        exact = (2 * max(self.full, default=0) + 1) * max(weights, default=1) < 1 << 62
        self.kind = np.int64 if exact else object  # Python's long integers beyond 64 bits
        self.weights = weights
        tails = [t % quantum for t in totals]
        base = sum(self.full) * quantum
        self.tail = [base + sum(tails[:i]) for i in range(len(tails))]

    def rank(self, queue: np.ndarray, granule: np.ndarray) -> np.ndarray:
        """Granules served before granule ``granule`` of queue ``queue``."""
        weights = np.array(self.weights, self.kind)
        mine, turn = weights[queue], 2 * granule.astype(self.kind) + 1
        rank = granule.astype(self.kind)
        for other, (weight, size) in enumerate(zip(self.weights, self.full)):
            lead = turn * weight - mine
            # due earlier, or at the same time in an earlier queue
            served = np.where(queue > other, lead // (2 * mine) + 1,
                              (lead + 2 * mine - 1) // (2 * mine))
            served = np.minimum(np.maximum(served, 0), size)
            rank = rank + np.where(queue == other, 0, served)
        return rank.astype(np.int64)

    def pieces(self, queue: np.ndarray, start: np.ndarray, count: np.ndarray,
               length: int = LENGTH) -> tuple[np.ndarray, ...]:
        """Cut runs [start, start + count) of their queues into pieces of the stream.

        Returns (run number, first id within the run, ids, stream position) per piece.
        """
        q = self.quantum
        limit = np.array(self.full, np.int64)[queue] * q
        run, lo, hi, at = [], [], [], []
        whole = np.maximum(0, np.minimum(start + count, limit) - start)
        some = np.flatnonzero(whole)
        if len(some):
            a, b = start[some], start[some] + whole[some]
            first, number = a // q, (b - 1) // q - a // q + 1
            owner = np.repeat(np.arange(len(some)), number)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            granule = first[owner] + step
            x, y = np.maximum(a[owner], granule * q), np.minimum(b[owner], (granule + 1) * q)
            run.append(some[owner])
            lo.append(x)
            hi.append(y)
            at.append(self.rank(queue[some][owner], granule) * q + x - granule * q)
        rest = np.flatnonzero(count > whole)
        if len(rest):
            a = np.maximum(start[rest], limit[rest])
            b = start[rest] + count[rest]
            place = np.array(self.tail, np.int64)[queue[rest]] + a - limit[rest]
            number = (place + b - a - 1) // length - place // length + 1
            owner = np.repeat(np.arange(len(rest)), number)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            window = place[owner] // length + step
            x = np.maximum(place[owner], window * length)
            y = np.minimum((place + b - a)[owner], (window + 1) * length)
            run.append(rest[owner])
            lo.append(a[owner] + x - place[owner])
            hi.append(a[owner] + y - place[owner])
            at.append(x)
        if not run:
            none = np.zeros(0, np.int64)
            return none, none, none, none
        run, lo, hi, at = (np.concatenate(v) for v in (run, lo, hi, at))
        order = np.lexsort((lo, run))
        run, lo, hi, at = run[order], lo[order], hi[order], at[order]
        # join neighbours that lie side by side in one sequence
        joined = ((run[1:] == run[:-1]) & (at[1:] == at[:-1] + hi[:-1] - lo[:-1])
                  & (at[1:] // length == at[:-1] // length))
        head = np.flatnonzero(np.concatenate([[True], ~joined]))
        sizes = np.add.reduceat(hi - lo, head)
        return run[head], lo[head] - start[run[head]], sizes, at[head]


def pack(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, end_id: int | None = 0,
         length: int = LENGTH, quantum: int = QUANTUM,
         targets: dict[str | None, int] | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` ids.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source and, if
    asked for, the ids. ``targets`` gives integer weights per source (default: each source's
    share of the ids; an unlisted source gets weight 1). Only the last sequence is shorter
    than ``length``; a reader pads it unless its length is a power of two. One queue is kept
    per distinct source, with a row per source on the driver.
    """
    ids = written(tokenized(docs, vocabulary, end_id), "packing-ids")
    runs = ids.groupBy("part", "source").agg(F.sum("n_tokens").alias("n"))
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(runs.select("part", "source", "n",
                                F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")),
                    "packing-bases")
    totals = (bases.groupBy("source").agg(F.sum("n").alias("n"))
              .orderBy(F.col("source").asc_nulls_first()).collect())
    queues = {row["source"]: i for i, row in enumerate(totals)}
    weights = None if targets is None else [targets.get(s, 1) for s in queues]
    schedule = Schedule([row["n"] for row in totals], weights, quantum)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, source string") + ", ids array<long>" * with_ids

    def place(batches):
        for batch in batches:
            count = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            queue = np.array([queues[s] for s in batch.column("source").to_pylist()], np.int64)
            run, first, size, at = schedule.pieces(
                queue, batch.column("start").to_numpy(zero_copy_only=False), count, length)
            blobs = [memoryview(x) for x in batch.column("ids").to_pylist()]
            cuts = [blobs[r][4 * a:4 * (a + n)] for r, a, n in
                    zip(run.tolist(), first.tolist(), size.tolist())]
            take = pa.array(run)
            columns = [batch.column("doc_id").take(take), pa.array(first), pa.array(size),
                       pa.array([zlib.crc32(x) for x in cuts], pa.int64()), pa.array(count[run]),
                       pa.array(at // length), pa.array(at % length),
                       batch.column("source").take(take)]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4") for x in cuts],
                                        pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    joined = (ids.alias("i").join(bases.alias("b"),
                                  (F.col("i.part") == F.col("b.part"))
                                  & F.col("i.source").eqNullSafe(F.col("b.source")))
              .select("i.doc_id", "i.source", "i.n_tokens", "i.ids",
                      (F.col("i.before") + F.col("b.base")).alias("start")))
    return joined.mapInArrow(place, schema)
