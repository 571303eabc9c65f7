"""Continuous user history.

A capture may arrive in any number of files and micro-batches and in any order.  So
the stream keeps what it has seen, not a merged history: each micro-batch is
written once as ``<target>/observations/batch=<id>`` (overwritten by a replay of the
same batch, so a failed or repeated batch leaves no trace), and the history is the
bulk build (C2) over all observations.  Nothing already written is copied; storage
grows with the captures alone.

An observation seen twice changes nothing.  Two different rows of one key with
the same capture time contradict each other and are reported, as in C1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators.history import USER_CHECK_COLS, SnapshotError, scd2_from_captures

OBSERVATIONS = "observations"


def store_batch(target: str):
    """The ``foreachBatch`` function: keep the micro-batch under its id."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{OBSERVATIONS}/batch={batch_id}")
    return fn


def observations(spark: SparkSession, target: str) -> DataFrame:
    """All observations so far; an unreadable store raises, it never counts as empty."""
    return spark.read.parquet(f"{target}/{OBSERVATIONS}").drop("batch")


def contradictions(seen: DataFrame, key: str = "user_id", ts_col: str = "capture_ts") -> DataFrame:
    """(key, capture time, n): keys with several different rows at one capture time."""
    row = F.struct(*[F.col(c) for c in USER_CHECK_COLS])
    return (seen.groupBy(key, ts_col).agg(F.count_distinct(F.to_json(row)).alias("n")).filter("n > 1"))


def user_history(spark: SparkSession, target: str, key: str = "user_id", validate: bool = True) -> DataFrame:
    """The history of everything seen; with ``validate`` (an action) contradictions raise."""
    seen = observations(spark, target)
    if validate and not contradictions(seen, key).isEmpty():
        raise SnapshotError(f"one {key!r} has different rows at the same capture time")
    return scd2_from_captures(seen, key)


def run_scd2_stream(captures: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Run a capture stream to completion (availableNow) and return the history."""
    q = (captures.writeStream.foreachBatch(store_batch(target))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return user_history(captures.sparkSession, target)
