"""Change history of users (SCD type 2): capture merge, bulk build, dimension.

Snapshot rows carry the tracked columns plus ``scd_id``, ``scd_valid_from`` and
``scd_valid_to`` (NULL while open).  A new version opens whenever any check
column differs null-safely from the key's open version; a key missing from a
capture keeps its open version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.functions.keys import epoch_seconds, surrogate_key
from reelhouse.session import checkpoint_root

# Fixed values.
USER_CHECK_COLS = ("membership_tier", "region", "device_preference")
BEGINNING_OF_TIME = "1900-01-01 00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"
SNAPSHOT_META = ("scd_id", "scd_valid_from", "scd_valid_to")


class SnapshotError(ValueError):
    """A capture that cannot be merged (duplicate key or out-of-order time)."""


def scd2_from_captures(captures: DataFrame, key: str = "user_id",
                       check_cols: Sequence[str] = USER_CHECK_COLS,
                       ts_col: str = "capture_ts") -> DataFrame:
    """The whole history from a table of captures in one pass.

    ``captures`` holds one row per (key, capture time).  Rows are shuffled by key
    only; each key holds one row per capture, so groups stay small even when a
    key dominates the facts.  Equal to folding :func:`scd2_capture` over the
    captures in time order.
    """
    w = Window.partitionBy(key).orderBy(ts_col)
    flagged = captures.withColumn("_first", F.lag(F.lit(1)).over(w).isNull())
    cond = F.col("_first")
    for c in check_cols:
        flagged = flagged.withColumn(f"_prev_{c}", F.lag(c).over(w))
        cond = cond | ~F.col(c).eqNullSafe(F.col(f"_prev_{c}"))
    versions = flagged.filter(cond).drop("_first", *[f"_prev_{c}" for c in check_cols])
    return (versions
            .withColumn("scd_valid_to", F.lead(ts_col).over(w))
            .withColumn("scd_id", surrogate_key(key, epoch_seconds(F.col(ts_col))))
            .withColumnRenamed(ts_col, "scd_valid_from"))


def scd2_capture(history: DataFrame | None, current: DataFrame, capture_ts,
                 key: str = "user_id", check_cols: Sequence[str] = USER_CHECK_COLS,
                 last_capture_ts=None, validate: bool = True) -> DataFrame:
    """Merge one capture into the history; returns the new history.

    ``history`` None (or empty) starts a new one.  With ``validate`` the capture
    is checked first (these checks are actions): a key twice in ``current`` or a
    ``capture_ts`` older than the newest version raises :class:`SnapshotError`.
    A capture may come in parts: at the newest version's own time, keys that
    already have a version from this capture stay as they are and all others are
    merged, so the same part twice changes nothing.
    Write the result to a fresh path and swap (see ``sources.sinks``).
    """
    ts = F.lit(capture_ts).cast("timestamp") if not isinstance(capture_ts, Column) else capture_ts
    data_cols = [c for c in current.columns if c != "capture_ts"]
    current = current.select(*data_cols)
    if validate:
        dup = current.groupBy(key).count().filter("count > 1").limit(1).count()
        if dup:
            raise SnapshotError(f"key {key!r} appears more than once in the capture")
    if history is None:
        return (current.withColumn("scd_valid_from", ts)
                .withColumn("scd_valid_to", F.lit(None).cast("timestamp"))
                .withColumn("scd_id", surrogate_key(key, epoch_seconds(ts))))
    if validate:
        # compared inside Spark, so the client's time zone plays no part
        last = (history.agg(F.max("scd_valid_from").alias("last")) if last_capture_ts is None
                else history.sparkSession.range(1).select(F.lit(last_capture_ts).cast("timestamp").alias("last")))
        if last.select((F.col("last") > ts).alias("older")).first()["older"]:
            raise SnapshotError("the capture is older than the newest version")
    hist_cols = history.columns
    closed = history.filter(F.col("scd_valid_to").isNotNull())
    open_ = history.filter(F.col("scd_valid_to").isNull())
    o, c = open_.alias("o"), current.alias("c")
    joined = o.join(c, F.col(f"o.{key}") == F.col(f"c.{key}"), "full_outer")
    changed = F.lit(False)
    for col in check_cols:
        changed = changed | ~F.col(f"o.{col}").eqNullSafe(F.col(f"c.{col}"))
    has_old = F.col(f"o.{key}").isNotNull()
    has_new = F.col(f"c.{key}").isNotNull()
    changed = has_old & has_new & changed & (F.col("o.scd_valid_from") < ts)
    new_values = {
        **{x: F.col(f"c.{x}") for x in data_cols},
        "scd_valid_from": ts,
        "scd_valid_to": F.lit(None).cast("timestamp"),
        "scd_id": surrogate_key(F.col(f"c.{key}"), epoch_seconds(ts)),
    }
    old_values = {x: F.col(f"o.{x}") for x in hist_cols}
    old_values["scd_valid_to"] = F.when(changed, ts).otherwise(F.col("o.scd_valid_to"))
    # one pass over the join: each key yields its old version (closed if it
    # changed) and/or the version this capture opens
    old_row = F.when(has_old, F.struct(*[old_values[x].alias(x) for x in hist_cols]))
    new_row = F.when(has_new & (~has_old | changed), F.struct(*[new_values[x].alias(x) for x in hist_cols]))
    merged = (joined.select(F.explode(F.array(old_row, new_row)).alias("r"))
              .filter(F.col("r").isNotNull()).select("r.*"))
    return closed.unionByName(merged)


def dim_user(snapshot: DataFrame) -> DataFrame:
    """One row per user version with ``user_sk``, validity and ``is_current``.

    The earliest version of each user opens at 1900-01-01 so historic events
    find it; an open version ends at 9999-12-31."""
    first = F.min("scd_valid_from").over(Window.partitionBy("user_id"))
    return snapshot.select(
        surrogate_key("user_id", "scd_id").alias("user_sk"),
        "user_id", "membership_tier", "region", "device_preference", "created_at",
        F.when(F.col("scd_valid_from") == first, F.lit(BEGINNING_OF_TIME).cast("timestamp"))
         .otherwise(F.col("scd_valid_from")).alias("valid_from"),
        F.coalesce(F.col("scd_valid_to"), F.lit(END_OF_TIME).cast("timestamp")).alias("valid_to"),
        F.col("scd_valid_to").isNull().alias("is_current"))


def dim_user_as_of(dim: DataFrame, ts) -> DataFrame:
    """Each user's version valid at ``ts`` (half-open validity)."""
    t = F.lit(ts).cast("timestamp") if not isinstance(ts, Column) else ts
    return dim.filter((F.col("valid_from") <= t) & (t < F.col("valid_to")))


def version_overlaps(dim: DataFrame, key: str = "user_id", sk: str = "user_sk",
                     start: str = "valid_from", end: str = "valid_to",
                     num_partitions: int | None = None) -> DataFrame:
    """Versions of one key whose validity overlaps an earlier version.

    Instead of a self join (all pairs of a key's versions), versions are ordered
    by (key, start, sk) and each is compared with the earlier version reaching
    furthest: any overlap implies an overlap with that one.  One row per
    offending version: ``a`` is the later version, ``b`` the witness.

    Skew-safe: versions are range-partitioned on (key, start, sk), so a key
    holding a third of all versions spans several partitions.  The running
    maximum is computed per (partition, key) and the part coming from earlier
    partitions of the same key is a carry: one row per partition boundary a
    key crosses, i.e. at most ``num_partitions - 1`` rows, broadcast.  Range bounds
    are sampled, so the partition of each version is fixed once by a checkpoint (an
    action) before two branches of the plan use it."""
    checkpoint_root(dim.sparkSession)
    n = num_partitions or int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wstruct = F.struct(F.col(end).alias("t"), F.col(start).alias("f"), F.col(sk).alias("sk"))
    ranged = (dim.select(key, sk, start, end)
              .repartitionByRange(n, key, start, sk)
              .withColumn("_p", F.spark_partition_id()).checkpoint())
    # the version ending last per (partition, key), then carried across the
    # partitions a key spans (rows per key <= partitions spanned)
    per_part = ranged.groupBy("_p", key).agg(F.max(wstruct).alias("_w"))
    spans = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carry = (per_part.select("_p", key, F.max("_w").over(spans).alias("_carry"))
             .filter(F.col("_carry").isNotNull()))
    # earlier versions inside the same range partition
    local = Window.partitionBy("_p", key).orderBy(start, sk).rowsBetween(Window.unboundedPreceding, -1)
    witness = (ranged.withColumn("_local", F.max(wstruct).over(local))
               .join(F.broadcast(carry), ["_p", key], "left")
               .withColumn("w", F.greatest("_local", "_carry")))
    return (witness
            .filter(F.col("w").isNotNull()
                    & (F.col(start) < F.col("w.t")) & (F.col(end) > F.col("w.f")))
            .select(key, F.col(sk).alias("a_sk"), F.col("w.sk").alias("b_sk"),
                    F.col(start).alias("a_from"), F.col(end).alias("a_to"),
                    F.col("w.f").alias("b_from"), F.col("w.t").alias("b_to")))
