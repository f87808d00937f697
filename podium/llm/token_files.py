"""Token-id files: whole texts as Simple-8b coded ids, in ascending document order.

``write_token_files`` tokenises, range-partitions by ``doc_id`` and writes one file per
range. A file row is a segment of whole documents with about ``SEGMENT`` ids: their ids and
counts, the coded words, and the word number of each block of 256 ids. Spark's Parquet
writer holds the rows, so a lost executor only repeats its ranges and files commit once.
``read_token_files`` and ``token_digests`` decode the files; nothing is tokenised again.

Defined cases: a null text is empty, an empty text holds only the end id; null ``doc_id``
comes first; repeated rows each keep their own ids (ordered by text); an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm import simple8b
from podium.llm.common import row_slices
from podium.llm.tokens import DEFAULT_VOCABULARY, encoder

SEGMENT = 1 << 16
FILE_SCHEMA = ("part int, base long, n_tokens long, doc_ids array<long>, counts array<long>, "
               "offsets binary, words binary")


def write_token_files(docs: DataFrame, path: str, vocabulary: str = DEFAULT_VOCABULARY,
                      end_id: int | None = 2, files: int | None = None) -> str:
    """Encode every text of ``docs`` (doc_id, text) below ``path``; returns ``path``."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches):
        tokens, part, base = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in row_slices(batches, "text"):
            doc_ids = batch.column("doc_id").to_pylist()
            ids, counts = tokens.encode(batch.column("text").to_pylist(), len(doc_ids), end_id)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            rows, first = [], 0
            while first < len(doc_ids):
                last = int(np.searchsorted(bounds, bounds[first] + SEGMENT, side="left"))
                last = min(max(last, first + 1), len(doc_ids))
                run = ids[bounds[first]:bounds[last]]
                words, offsets = simple8b.encode(run)
                rows.append((part, base, len(run), doc_ids[first:last], counts[first:last],
                             offsets.astype("<i4").tobytes(), words.astype("<u8").tobytes()))
                base += len(run)
                first = last
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], type_) for i, type_ in enumerate(_ARROW)], _NAMES)

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
     .repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, FILE_SCHEMA)
     .write.option("compression", "zstd").parquet(path))
    return path


_NAMES = ["part", "base", "n_tokens", "doc_ids", "counts", "offsets", "words"]
_ARROW = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
          pa.binary(), pa.binary()]


def _bases(files: DataFrame) -> dict[int, int]:
    """Ids before each range; one small row per file."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    bases, before = {}, 0
    for row in totals:
        bases[row["part"]] = before
        before += row["n"]
    return bases


def _segments(batch: pa.RecordBatch):
    """(part, base, doc ids, counts, ids) of every segment row."""
    for row in batch.to_pylist():
        words = np.frombuffer(row["words"], "<u8")
        offsets = np.frombuffer(row["offsets"], "<i4")
        ids = simple8b.decode(words, row["n_tokens"], offsets).astype("<u4")
        yield row["part"], row["base"], row["doc_ids"], np.asarray(row["counts"], np.int64), ids


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document in the files below ``path``."""
    def decode(batches):
        for batch in batches:
            for _, _, doc_ids, counts, ids in _segments(batch):
                ends = np.cumsum(counts)
                lists = [ids[e - c:e] for e, c in zip(ends, counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                    ["doc_id", "ids"])

    return spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(
        decode, "doc_id long, ids array<long>")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    bases = _bases(files)

    def digest(batches):
        for batch in batches:
            for part, base, doc_ids, counts, ids in _segments(batch):
                ends = np.cumsum(counts)
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * (e - c):4 * e]) for e, c in zip(ends, counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()),
                     pa.array(ends - counts + (bases[part] + base), pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
