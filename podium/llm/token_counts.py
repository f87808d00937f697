"""Token-count rollups kept up to date by signed deltas.

A change row states that a document's counts were inserted, deleted or revised. Its signed
rows (+ new, - old) are summed by source, language and tokenizer version before anything is
stored, so a batch stores one small row per group. A batch is a folder named by its id, which
Spark's committer marks when it is whole; ids rise. Committing an id again compares the sums and
changes nothing; other sums under an old id are refused. A folder without its mark, left by a lost
driver, is not read and is written anew.

Totals are maintained: each commit adds its batch to the totals of the last one and stores them
with the batch id as high-water mark. A reader takes the totals of the highest mark and adds the batches
behind it, should a driver have been lost between the two. Documents and older batches are not read again.

Defined cases: null source, language or text are groups and empty texts of their own; a
revision without a known old count is an insert; repeated rows count once per row; an empty
batch commits and changes nothing; groups whose rows all went keep no line.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.tokens import DEFAULT_VOCABULARY, encoder

GROUP = ("source", "lang", "tokenizer")
DELTA_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, chars long"


def counted(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens, chars) of every whole text."""
    def count(batches):
        tokens = encoder(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            _, counts = tokens.encode(texts, len(texts))
            chars = np.array([len(x or "") for x in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), batch.column("lang"),
                 pa.array(counts), pa.array(chars)],
                ["doc_id", "source", "lang", "tokens", "chars"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                        F.col("source").cast("string").alias("source"),
                        F.col("lang").cast("string").alias("lang"))
            .mapInArrow(count, "doc_id long, source string, lang string, tokens long, chars long")
            .withColumn("tokenizer", F.lit(vocabulary)))


def estimated(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, chars_per_token: int = 4) -> DataFrame:
    """As ``counted``, with a count estimated from the length (for a first, cheap insert)."""
    chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), F.lit(vocabulary).alias("tokenizer"),
                       F.floor(chars / chars_per_token).alias("tokens"), chars.alias("chars"))


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Counted rows as deltas: +1 inserts them, -1 deletes them; a revision is the union of
    the old rows at -1 and the new rows at +1."""
    return rows.select(*GROUP, F.lit(sign).cast("long").alias("docs"),
                       *[(F.lit(sign) * F.col(c)).cast("long").alias(c) for c in ("tokens", "chars")])


SUMS = ("docs", "tokens", "chars")


def _summed(rows: DataFrame) -> DataFrame:
    """One row per group with any sum that is not zero."""
    changed: Column = (F.col("docs") != 0) | (F.col("tokens") != 0) | (F.col("chars") != 0)
    return rows.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS]).where(changed)


class Rollup:
    """Totals by source, language and tokenizer version below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _marked(self, key: str) -> list[int]:
        """Values of the folders ``<key>=<value>`` that are whole, in order."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(folder.suffix(f"/{key}=*/_SUCCESS")) or []
        return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in found)

    def _read(self, key: str, values: list[int]) -> DataFrame:
        if not values:
            return self.spark.createDataFrame([], DELTA_SCHEMA)
        return self.spark.read.schema(DELTA_SCHEMA).parquet(*[f"{self.path}/{key}={v}" for v in values])

    def commit(self, batch_id: int, *deltas: DataFrame) -> None:
        """Commit the signed rows of a batch and bring the totals up to it."""
        batch_id = int(batch_id)
        rows = deltas[0]
        for more in deltas[1:]:
            rows = rows.unionByName(more)
        sums, done = _summed(rows), self.batches()
        if batch_id in done:
            own = self._read("batch_id", [batch_id])
            negated = sums.select(*GROUP, *[(-F.col(c)).alias(c) for c in SUMS])
            if _summed(own.unionByName(negated)).take(1):
                raise ValueError(f"batch {batch_id} is committed with other sums")
            return
        if done and batch_id < done[-1]:
            raise ValueError(f"batch {batch_id} comes after batch {done[-1]}: ids must rise")
        sums.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")  # nothing whole lies there
        self.totals().write.mode("overwrite").parquet(f"{self.path}/totals_to={batch_id}")

    def batches(self) -> list[int]:
        """Ids of the committed batches."""
        return self._marked("batch_id")

    def deltas(self) -> DataFrame:
        """The sums of all committed batches."""
        return self._read("batch_id", self.batches())

    def totals(self) -> DataFrame:
        """Current totals: those of the high-water mark and the batches behind it."""
        mark = self._marked("totals_to")[-1:]
        behind = [b for b in self.batches() if not mark or b > mark[0]]
        kept = self._read("totals_to", mark)
        return _summed(kept.unionByName(self._read("batch_id", behind))) if behind else kept
