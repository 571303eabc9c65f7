"""Reproducible synthetic users (A10).

Re-aimed from a sequential random generator to per-row hashing: each user's
attributes depend only on (user_id, seed), so the table is generated in
parallel and is identical however it is partitioned or recomputed after an
executor loss.  Same distributions, other values.  The hash is the leading 8
hex digits of an MD5, which any SQL engine can reproduce.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Categories and weights; date range of created_at.
TIER_WEIGHTS = (("basic", 0.30), ("standard", 0.40), ("premium", 0.30))
REGION_WEIGHTS = (("NA", 0.40), ("EU", 0.30), ("APAC", 0.20), ("LATAM", 0.10))
DEVICES = ("desktop", "mobile", "tablet", "tv")
CREATED_FROM, CREATED_TO = "2015-01-01", "2024-12-31"
DEFAULT_USERS = 162_541

_SPAN = 16 ** 8


def _draw(uid: Column, seed: int, salt: str) -> Column:
    """Deterministic integer in [0, 16^8) per (id, seed, salt)."""
    text = F.concat_ws("-", uid.cast("string"), F.lit(str(seed)), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _weighted(draw: Column, options) -> Column:
    expr, cum = None, 0
    for value, weight in options[:-1]:
        cum += round(weight * 100)
        cond = draw < F.lit(cum * _SPAN // 100)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(options[-1][0]))


def users_for_ids(ids: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Synthetic attributes for every id in ``ids`` (weighted tier and region,
    uniform device and creation date)."""
    uid = F.col(id_col)
    from datetime import date
    days = (date.fromisoformat(CREATED_TO) - date.fromisoformat(CREATED_FROM)).days + 1
    return ids.select(
        uid.cast("int").alias("user_id"),
        _weighted(_draw(uid, seed, "tier"), TIER_WEIGHTS).alias("membership_tier"),
        _weighted(_draw(uid, seed, "region"), REGION_WEIGHTS).alias("region"),
        F.element_at(F.array(*[F.lit(d) for d in DEVICES]),
                     (F.pmod(_draw(uid, seed, "device"), F.lit(len(DEVICES))) + 1).cast("int"))
         .alias("device_preference"),
        F.date_add(F.lit(CREATED_FROM).cast("date"),
                   F.pmod(_draw(uid, seed, "created"), F.lit(days)).cast("int")).alias("created_at"))


def synthesize_users(spark: SparkSession, n: int = DEFAULT_USERS, seed: int = 42,
                     num_partitions: int | None = None) -> DataFrame:
    """user_id 1..n, generated in parallel by ``spark.range``."""
    return users_for_ids(spark.range(1, n + 1, numPartitions=num_partitions), "id", seed)
