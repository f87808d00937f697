"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut, its size is known."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Hands memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def releasing(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` over batches, with ``release`` at its end: a Python worker outlives its task and would
    hold the memory while the executor runs the next stages."""
    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        release()

    return run


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a column as text, modulo ``modulus`` (null when the column is null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def segments(text: str, size: int) -> Iterator[str]:
    """``text`` in slices of about ``size`` characters, cut only before a lone space.

    Neither neighbour of such a space is white space, so no word or pre-token spans a cut.
    """
    start, n = 0, len(text)
    while n - start > size:
        cut = text.find(" ", start + size)
        while 0 <= cut < n - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut >= n - 1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def blocks(texts: Iterable[str | None], size: int = 2_000_000) -> Iterator[tuple[list[str], list[int]]]:
    """Lists of text slices with their row numbers, each list of about ``size`` characters.

    Bounds the memory of a batch: a very long text is dealt over several lists.
    """
    part: list[str] = []
    rows: list[int] = []
    total = 0
    for i, text in enumerate(texts):
        for piece in segments(text, size) if text else ():
            part.append(piece)
            rows.append(i)
            total += len(piece)
            if total >= size:
                yield part, rows
                part, rows, total = [], [], 0
    if part:
        yield part, rows


def row_slices(batches: Iterable[pa.RecordBatch], column: str, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches' rows in runs of about ``size`` bytes of text in ``column``, whole rows in order.

    A batch holds rows by their number; what is made of one run at a time stays small however long the rows are.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = (np.cumsum(lengths, dtype=np.int64) - lengths) // size
        cuts = [*np.flatnonzero(np.diff(run, prepend=-1)).tolist(), batch.num_rows]
        for first, last in itertools.pairwise(cuts):
            yield batch.slice(first, last - first)


class PieceTable:
    """Memo of a function from text pieces to integer lists, applied to whole batches.

    A corpus repeats its words, so the costly function runs once per distinct piece and
    task; all else is one dictionary lookup per piece and numpy gathers. ``limit`` bounds
    the memo: when it is exceeded the memo starts anew, which only costs time.
    """

    def __init__(self, function, dtype, limit: int = 300_000):
        self.function, self.dtype, self.limit = function, dtype, limit
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.values = np.zeros(0, self.dtype)

    def codes(self, pieces: list[str]) -> np.ndarray:
        if len(self.index) > self.limit:
            self._reset()
        index = self.index
        new = list(set(pieces).difference(index))
        if new:
            found = self.function(new)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            base, size = len(index), len(self.values)
            index.update(zip(new, range(base, base + len(new))))
            self.starts = np.concatenate([self.starts, size + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            flat = np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(lengths.sum()))
            self.values = np.concatenate([self.values, flat])
        return np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))

    def flat(self, pieces: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Values of all pieces in order, and how many belong to each list."""
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        codes = self.codes([x for p in pieces for x in p])
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(total)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        sums = np.concatenate([[0], ends])[bounds]
        return self.values[at], np.diff(sums)


def gather(pieces_of, table_: PieceTable, texts: Iterable[str | None], n: int,
           size: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(values, row numbers, counts) per block of texts; a row may occur in several blocks."""
    for part, rows in blocks(texts, size):
        values, counts = table_.flat([pieces_of(x) for x in part])
        yield values, np.asarray(rows, np.int64), counts
