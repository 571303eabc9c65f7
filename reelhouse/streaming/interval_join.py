"""Interval join of two streams: what follows an event of the same key within some time.

Both sides carry a watermark, and the time condition bounds how long a row can still find a partner, so
Spark drops it from the state once that has passed: the state is the rows of ``lateness`` plus
``within``, whatever the length of the streams.  Rows later than ``lateness`` find nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, within: str,
                  lateness: str) -> DataFrame:
    """Every row of ``left`` with every row of ``right`` of equal keys and
    ``left_at <= right_at <= left_at + within``; columns of both, the keys once.  Both frames are streams, or
    both batches (the same rows result)."""
    def timed(df: DataFrame, at: str) -> DataFrame:
        df = df.withColumn(at, F.col(at).cast("timestamp"))
        return df.withWatermark(at, lateness) if df.isStreaming else df

    a = timed(left, left_at)
    b = timed(right, right_at).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    near = (F.col(right_at) >= F.col(left_at)) & (F.col(right_at) <= F.col(left_at) + F.expr(f"INTERVAL {within}"))
    return a.join(b, same & near).drop(*[f"_{k}" for k in keys])
