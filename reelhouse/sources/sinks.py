"""Gold writes, pruned reads and the run audit table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.keys import key_columns, packed_keys, unpacked_keys

# keys are digits of a hash: an entropy coder halves them, the default codec cannot
CODEC = "zstd"


def write_gold(df: DataFrame, path: str, partition_by: Sequence[str] | str | None = None,
               mode: str = "overwrite", dynamic: bool = False) -> str:
    """Write a gold table as Parquet, optionally partitioned (e.g. the fact
    by ``rating_year``, or by year and month, I4).  ``dynamic`` overwrites only
    the partitions present in ``df``.

    A partitioned write is rebalanced on the partition columns: AQE joins small
    partitions and splits large ones by bytes, so a value gets as many files as its size
    asks for, neither one file per task nor one task per year.  Surrogate keys are packed on that way."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if cols:
        keys = [c for c in key_columns(df) if c not in cols]
        df = unpacked_keys(packed_keys(df, but=cols).hint("rebalance", *cols), keys)
    writer = df.write.mode(mode).option("compression", CODEC)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    return path


def read_gold_pruned(spark: SparkSession, path: str, years: Sequence[int] | None = None,
                     column: str = "rating_year") -> DataFrame:
    """Read a partitioned gold table keeping only some partitions; the
    filter on the partition column becomes a PartitionFilter of the scan, so
    other years are never listed or read."""
    df = spark.read.parquet(path)
    return df if years is None else df.filter(F.col(column).isin(list(years)))


def drop_partition(spark: SparkSession, path: str, column: str, value) -> None:
    """Remove one partition of a partitioned table (an overwrite leaves partitions it has no rows for)."""
    drop_folder(spark, f"{path}/{column}={value}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark reaches; nothing if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def audit_row(spark: SparkSession, run_id: str, counts: DataFrame | None, report: DataFrame | None,
              execution_ts=None, status: str | None = None) -> DataFrame:
    """The one audit row of a run as a DataFrame (lazy).

    ``counts`` is (source, n) from ``source_row_counts``; ``report`` a quality
    report with an ``overall`` row whose message is ``rows=<n>``; ``status``, if given, is
    that of the whole run (more checks than the report's).  Missing inputs (a failed
    upstream step) give 'unknown' and zeros."""
    ts = F.current_timestamp() if execution_ts is None else F.lit(execution_ts).cast("timestamp")
    base = spark.range(1).select(F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n"),
                                 F.lit(None).cast("string").alias("check"),
                                 F.lit(None).cast("string").alias("status"),
                                 F.lit(None).cast("string").alias("message"))
    parts = base
    if counts is not None:
        parts = parts.unionByName(counts.select("source", "n"), allowMissingColumns=True)
    if report is not None:
        parts = parts.unionByName(report.filter(F.col("check") == "overall").select("check", "status", "message"),
                                  allowMissingColumns=True)

    def count_of(name):
        return F.coalesce(F.max(F.when(F.col("source") == name, F.col("n"))), F.lit(0)).cast("long")

    observed = F.coalesce(F.max(F.when(F.col("check") == "overall", F.col("status"))), F.lit("unknown"))
    rows = F.coalesce(F.max(F.when(F.col("check") == "overall",
                                   F.regexp_extract("message", r"rows=(\d+)", 1).try_cast("long"))), F.lit(0).cast("long"))
    return parts.agg(observed.alias("observe_status"), count_of("ratings").alias("seed_ratings_rows"),
                     count_of("movies").alias("seed_movies_rows"), count_of("tags").alias("seed_tags_rows"),
                     count_of("users").alias("seed_users_rows"), rows.alias("gold_mart_rows")).select(
        F.lit(run_id).alias("run_id"), ts.alias("execution_date"),
        (F.col("observe_status") if status is None else F.lit(status)).alias("status"), "seed_ratings_rows",
        "seed_movies_rows", "seed_tags_rows", "seed_users_rows", "gold_mart_rows", "observe_status")


def append_run_audit(spark: SparkSession, path: str, run_id: str, counts: DataFrame | None,
                     report: DataFrame | None, execution_ts=None, status: str | None = None) -> DataFrame:
    """Append the run's audit row to the Parquet table at ``path``."""
    row = audit_row(spark, run_id, counts, report, execution_ts, status)
    row.write.mode("append").parquet(path)
    return spark.read.parquet(path)
