"""Continuous bronze -> silver ratings.

The silver transformation is B1 unchanged.  Replays are recognised by (user, movie,
second, value): the value is part of the key, otherwise two different ratings in one
second (the known ``rating_sk`` collision) would lose one at random.

:func:`run_silver_ratings` keeps no state at all: each micro-batch is compared with the months
of the sink that it touches (a left-anti join; only these months' files are read) and
only what they lack is appended, however late it arrives.  :func:`silver_ratings_stream` is the
stateful form for sinks that cannot be read back: its state is bounded by the
watermark, and rows older than that are returned by :func:`too_late`, not lost unseen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reelhouse.operators.silver import stage_ratings
from reelhouse.sources.files import RATINGS_SCHEMA
from reelhouse.sources.sinks import write_gold

DEDUP_KEY = ("user_id", "movie_id", "rated_at", "rating_value")


def batch_months(batch: DataFrame) -> list:
    """The months a batch touches (a value per month of the calendar at most)."""
    return sorted(r[0] for r in batch.select("rated_month").distinct().collect())


def held_before(spark: SparkSession, sink: str, schema: StructType, batch_id: int, months: list) -> DataFrame:
    """What earlier batches wrote of these months.  The months are literals, so they are partition filters
    of the scan: files of other months are not opened."""
    return (spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(sink)
            .filter((F.col("batch") < batch_id) & F.col("rated_month").isin(months)))


def append_new(sink: str):
    """The ``foreachBatch`` function: append the staged ratings that their months in the
    sink do not hold yet.  Each batch has a folder named by its id and reads only earlier
    ones, so a replay overwrites itself."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(list(DEDUP_KEY)).withColumn("rated_month", F.trunc("rated_at", "month")).persist()
        try:
            columns, months = new.columns, batch_months(new)
            if batch_id > 0 and months:
                held = held_before(spark, sink, new.schema, batch_id, months)
                new = (new.join(held.select("rated_month", *DEDUP_KEY), ["rated_month", *DEDUP_KEY], "left_anti")
                       .select(*columns))
            write_gold(new, f"{sink}/batch={batch_id}", "rated_month")
        finally:
            new.unpersist()
    return fn


def run_silver_ratings(raw_stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Stage everything available and return the silver ratings in ``sink``."""
    staged = stage_ratings(raw_stream)
    q = (staged.writeStream.foreachBatch(append_new(sink)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return staged.sparkSession.read.parquet(sink).select(*staged.columns)


def too_late(staged: DataFrame, sink: DataFrame) -> DataFrame:
    """Staged ratings (all that arrived, as a batch) that a watermarked sink does not hold."""
    return staged.dropDuplicates(list(DEDUP_KEY)).join(sink.select(*DEDUP_KEY), list(DEDUP_KEY), "left_anti")


def silver_ratings_stream(raw_stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Streaming DataFrame of staged, de-duplicated ratings, state bounded by ``lateness``."""
    return (stage_ratings(raw_stream)
            .withWatermark("rated_at", lateness)
            .dropDuplicatesWithinWatermark(list(DEDUP_KEY)))


def ratings_csv_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw ratings arriving as headered CSV files in ``source_dir``."""
    r = spark.readStream.schema(RATINGS_SCHEMA).option("header", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(source_dir)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available, then stop (exactly-once file sink)."""
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def batch_equivalent(raw: DataFrame) -> DataFrame:
    """The batch form of :func:`silver_ratings_stream`."""
    return stage_ratings(raw).dropDuplicates(list(DEDUP_KEY))


def lineitem_ratings_stream(spark: SparkSession, sf_dir: str, orders: DataFrame,
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw ratings from the driver's lineitem files read as a stream and
    joined to the static orders table (a stream-static join)."""
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    li = r.parquet(sf_dir).select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = orders.select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"),
                    (((F.col("l_quantity").cast("long") - 1) % 12) * 0.5).alias("rating"),
                    F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp")))
