"""Incremental scoring with Structured Streaming.

Result files land in a folder; each micro-batch is handled by ``foreachBatch``:

1. the batch's rows become race entries and are written to an ``entries`` table
   partitioned by (event, batch_id) with dynamic partition overwrite, so a replayed
   batch rewrites exactly its own partitions (idempotent);
2. the entries of the events that the batch touched are read back by a left-semi join on
   the batch's distinct events (null matches null; partitions are pruned at run time) and
   scored in full, because a field size depends on every row of the event;
3. their ``event_points`` partitions are overwritten (dynamic), untouched events
   keep their points.

No state store holds rows: the accumulated entries live in the table, so a group
is never collected into one task, and a restarted query resumes from its
checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import ensure_checkpoint_dir


def stream_root(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one streaming run."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/podium-stream/{name}-{uuid.uuid4().hex[:12]}"


def rescoring_batch(to_entries: Callable[[DataFrame], DataFrame],
                    score: Callable[[DataFrame], DataFrame], root: str, event_col: str = "event"):
    """The ``foreachBatch`` function: store entries, rescore the touched events."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ent = to_entries(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (ent.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(event_col, "batch_id").parquet(f"{root}/entries"))
        stored = spark.read.schema(ent.schema).parquet(f"{root}/entries")
        touched = (stored.filter(F.col("batch_id") == batch_id)
                   .select(F.col(event_col).alias("__touched")).distinct())
        stored = stored.drop("batch_id").join(
            touched, F.col(event_col).eqNullSafe(F.col("__touched")), "left_semi")
        (score(stored).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(event_col).parquet(f"{root}/event_points"))

    return run


def run_rescoring_stream(source: DataFrame, to_entries, score, root: str, event_col: str = "event",
                         available_now: bool = True):
    """Start the stream (``availableNow`` drains what has landed, then stops; otherwise every
    30 seconds). Files per micro-batch are set on the source (``file_stream``)."""
    writer = (source.writeStream
              .foreachBatch(rescoring_batch(to_entries, score, root, event_col))
              .option("checkpointLocation", f"{root}/_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def drain(query, timeout_s: int = 3600) -> None:
    """Wait for an ``availableNow`` query to finish; stop it and fail if it does not."""
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not drain in {timeout_s}s")


def file_stream(spark: SparkSession, path_glob: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet files landing under ``path_glob`` as a stream with a fixed schema."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path_glob))
