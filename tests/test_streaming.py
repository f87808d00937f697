"""Incremental scoring: two landed files, overlapping events, same result as batch."""

import tempfile

from pyspark.sql import functions as F

from podium.operators.event import score_event
from podium.plans import testbed as tb
from podium.streaming.incremental import file_stream, run_rescoring_stream
from tests.conftest import SMOKE

COLS = ["event", "division", "first_name", "last_name", "age", "division_place", "race_role", "points"]


def test_two_batches_match_batch_scoring(spark):
    landing = tempfile.mkdtemp(prefix="podium-landing-")
    out = tempfile.mkdtemp(prefix="podium-out-")
    orders = tb.table(spark, SMOKE, "orders")
    customer = tb.table(spark, SMOKE, "customer")
    # two result files; both contain orders of every year, so batch 2 rescores batch-1 events
    orders.filter(F.col("o_orderkey") % 2 == 0).coalesce(1).write.parquet(f"{landing}/a")
    orders.filter(F.col("o_orderkey") % 2 == 1).coalesce(1).write.parquet(f"{landing}/b")
    src = file_stream(spark, f"{landing}/*/*.parquet", orders.schema, max_files_per_trigger=1)
    q = run_rescoring_stream(src, lambda b: tb.entries_from_orders(b, customer),
                             lambda ent: score_event(tb.results_from_entries(ent)), out)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    got = spark.read.parquet(f"{out}/event_points").withColumn("event", F.col("event").cast("long"))
    want = tb.event_points(spark, SMOKE)
    assert got.select(*COLS).exceptAll(want.select(*COLS)).count() == 0
    assert want.select(*COLS).exceptAll(got.select(*COLS)).count() == 0
