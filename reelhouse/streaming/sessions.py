"""Viewer sessions over a stream of events.

A session of a user ends when the next event is more than a gap away.  Each micro-batch is reduced
to *pieces*: a user's first and last event and their number in each stretch of time as long as
the gap; events of one stretch are always of one session.  Pieces of any batches add up, so the
sink needs no state, no watermark and no order of files: an event that arrives late joins two
sessions or starts one as if it had been on time, and a replayed batch overwrites its own folder.
Sessions are the pieces merged (``merge_intervals``), a hot user's over several tasks.

:func:`session_window_stream` is the stateful form, for sinks that must be final: its state is
bounded by the lateness, and :func:`outside_sessions` returns the events that came too late for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.intervals import merge_intervals


def session_pieces(events: DataFrame, gap_seconds: int, user: str = "user_id", at: str = "ts") -> DataFrame:
    """(user, stretch, session_start, session_end, n_events); events without user or time are none."""
    t = F.col(at).cast("timestamp")
    return (events.filter(F.col(user).isNotNull() & F.col(at).isNotNull())
            .groupBy(user, F.floor(F.unix_micros(t) / (gap_seconds * 1_000_000)).alias("stretch"))
            .agg(F.min(t).alias("session_start"), F.max(t).alias("session_end"), F.count("*").alias("n_events")))


def sessions_of(pieces: DataFrame, gap_seconds: int, user: str = "user_id") -> DataFrame:
    """(user, session_start, session_end, n_events) from the pieces of any number of batches."""
    whole = pieces.groupBy(user, "stretch").agg(F.min("session_start").alias("session_start"),
                                                F.max("session_end").alias("session_end"), F.sum("n_events").alias("n_events"))
    return merge_intervals(whole, [user], "session_start", "session_end", gap=f"{gap_seconds} SECONDS",
                           sums=["n_events"]).drop("n_merged")


def run_sessions(events: DataFrame, sink: str, checkpoint: str, gap_seconds: int, user: str = "user_id",
                 at: str = "ts") -> DataFrame:
    """Take in everything available of the stream ``events``; return all sessions so far."""
    def keep(batch: DataFrame, batch_id: int) -> None:
        session_pieces(batch, gap_seconds, user, at).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    q = (events.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return sessions_of(events.sparkSession.read.parquet(sink), gap_seconds, user)


def session_window_stream(events: DataFrame, gap_seconds: int, lateness: str, user: str = "user_id",
                          at: str = "ts") -> DataFrame:
    """Streaming DataFrame of closed sessions (append), state bounded by ``lateness``."""
    timed = events.withColumn("_t", F.col(at).cast("timestamp")).withWatermark("_t", lateness)
    return (timed.groupBy(F.col(user), F.session_window("_t", f"{gap_seconds} seconds").alias("_w"))
            .agg(F.min("_t").alias("session_start"), F.max("_t").alias("session_end"), F.count("*").alias("n_events"))
            .select(user, "session_start", "session_end", "n_events"))


def outside_sessions(events: DataFrame, sessions: DataFrame, user: str = "user_id", at: str = "ts") -> DataFrame:
    """Events (as a batch) that no session of their user covers: too late for the stateful form, or its
    session is still open."""
    s = sessions.select(F.col(user).alias("_user"), "session_start", "session_end")
    t = F.col(at).cast("timestamp")
    return events.join(s, (F.col(user) == F.col("_user")) & (t >= F.col("session_start")) & (t <= F.col("session_end")), "left_anti")
