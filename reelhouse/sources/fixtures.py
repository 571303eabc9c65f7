"""Raw ratings / movies / tags / user captures derived from the driver tables.

The original rating, title and tag CSVs are not available here; these views
give the same raw shapes (bronze column names and types) from the TPC-H-like
tables, with the quirks the pipeline must handle: out-of-range ratings, titles
without a year or with a future year, messy tags, tier spellings outside the
accepted list, and users whose tier changes between captures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.sources.tables import read_table

# Fixed values of the fixture mapping.
CAPTURE_DATES = ("1996-01-01", "1998-01-01", "2000-01-01")
PRIORITY_TO_TIER = {"1": "PREMIUM", "2": "standard", "3": "basic", "4": "Standard", "5": "trial"}
REGION_NAME_TO_CODE = {"AMERICA": "NA", "EUROPE": "EU", "ASIA": "APAC"}
REGION_OTHER = "LATAM"
DEVICES = ("desktop", "mobile", "tablet", "tv")
TAG_ERROR_EVENT = "error"


def _ntz_epoch(c: str):
    # driver timestamps load as TIMESTAMP_NTZ; read them as UTC instants
    return F.unix_seconds(F.col(c).cast("timestamp"))


def fx_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, movieId, rating (DOUBLE, 0.0..5.5 in 0.5 steps), timestamp (epoch s)."""
    # hashed on the join key at every size: a file of one row group is one task otherwise, and a small table would be joined
    # into one again, which leaves a hot user nothing to be split by
    conf = spark.conf
    n = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))
    li = (read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
          .repartition(n, "l_orderkey"))
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("userId"),
                    F.col("l_partkey").alias("movieId"),
                    (((F.col("l_quantity").cast("long") - 1) % 12) * 0.5).alias("rating"),
                    _ntz_epoch("l_shipdate").alias("timestamp")))


def fx_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId, title ('name (year)'; some without a year or with year 3000), genres ('a|b')."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    k40 = F.col("p_partkey") % 40
    title = (F.when(k40 == 0, F.col("p_name"))
             .when(k40 == 1, F.concat(F.col("p_name"), F.lit(" (3000)")))
             .otherwise(F.concat(F.col("p_name"), F.lit(" ("),
                                 (F.lit(1968) + F.col("p_size")).cast("string"), F.lit(")"))))
    genres = (F.when(F.col("p_partkey") % 3 == 0, F.col("p_type"))
              .otherwise(F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand"))))
    return p.select(F.col("p_partkey").alias("movieId"), title.alias("title"), genres.alias("genres"))


def fx_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, movieId, tag (blank, upper-case or space-padded variants), timestamp."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    k3 = F.col("event_id") % 3
    tag = (F.when(F.col("event_type") == TAG_ERROR_EVENT, F.lit(""))
           .when(k3 == 0, F.upper("event_type"))
           .when(k3 == 1, F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
           .otherwise(F.col("event_type")))
    return e.select(F.col("user_id").alias("userId"), (F.col("event_id") % 20).alias("movieId"),
                    tag.alias("tag"), _ntz_epoch("ts").alias("timestamp"))


def fx_user_captures(spark: SparkSession, sf_dir: str,
                     capture_dates: Sequence[str] = CAPTURE_DATES) -> DataFrame:
    """Raw users table as captured on each date: capture_ts + raw users columns.

    A customer is present in a capture once it has an order before the capture
    date; its tier comes from the priority of its latest such order (by date,
    then order key).  One scan of orders: each order is expanded only to the
    captures it precedes (at most ``len(capture_dates)``), then partially
    aggregated per (customer, capture) before the shuffle.
    """
    caps = F.array(*[F.lit(d).cast("date").cast("timestamp") for d in capture_dates])
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("od"))
    # latest order by (date, order key), packed into one long so the
    # aggregation keeps fixed-width buffers and stays hash-based
    order_rank = (F.unix_date(F.to_date("od")).cast("long") * F.lit(1 << 40) + F.col("o_orderkey"))
    per_cap = (orders
               .withColumn("capture_ts", F.explode(F.filter(caps, lambda c: F.col("od") < c)))
               .groupBy("o_custkey", "capture_ts")
               .agg(F.max_by(F.substring("o_orderpriority", 1, 1).try_cast("int"), order_rank).alias("prio"),
                    F.min("od").alias("first_order")))
    tier = F.lit(None).cast("string")
    for digit, name in PRIORITY_TO_TIER.items():
        tier = F.when(F.col("prio") == int(digit), F.lit(name)).otherwise(tier)
    region_code = F.lit(REGION_OTHER)
    for name, code in REGION_NAME_TO_CODE.items():
        region_code = F.when(F.col("r_name") == name, F.lit(code)).otherwise(region_code)
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICES]), (F.col("o_custkey") % 4 + 1).cast("int"))
    geo = (read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
           .join(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .join(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("c_custkey", region_code.alias("region")))
    return (per_cap.join(geo, per_cap.o_custkey == geo.c_custkey)
            .select("capture_ts",
                    F.col("o_custkey").cast("int").alias("user_id"),
                    tier.alias("membership_tier"),
                    "region",
                    device.alias("device_preference"),
                    F.to_date("first_order").alias("created_at")))


# Fixed values of the licence fixture: contracts per (title, region) and the day they count from.
LICENCE_SLOTS = 4
LICENCE_EPOCH = "1994-01-01"


def fx_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movie_id, region, available_from, available_to: invented licence contracts of every title, drawn
    from an MD5 of (title, region, slot).  Contracts overlap; the last one touches the one before; some have no
    end, some are missing."""
    # a fixed number of tasks: a file of one row group is one task otherwise, and the few bytes of the keys would be
    # joined into one before they are expanded
    titles = (read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("movie_id"))
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "movie_id"))
    slots = (titles.withColumn("region", F.explode(F.array(*[F.lit(r) for r in ("NA", "EU", "APAC", "LATAM")])))
             .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(LICENCE_SLOTS - 1)))))

    def digest(slot):
        return F.md5(F.concat_ws("-", "movie_id", "region", slot.cast("string")))

    def digits(h, first, n):
        return F.conv(F.substring(h, first, n), 16, 10).cast("int")

    def start(h):
        return F.date_add(F.lit(LICENCE_EPOCH).cast("date"), digits(h, 2, 3) % 2600)

    def end(h):
        return F.date_add(start(h), digits(h, 5, 3) % 700 + 1)

    slot = F.col("slot")
    touching = slot == LICENCE_SLOTS - 1
    drawn = slots.withColumn("_h", digest(slot)).filter(digits("_h", 1, 1) < 10)
    before = end(digest(slot - 1))
    return drawn.select(
        "movie_id", "region", F.when(touching, before).otherwise(start("_h")).cast("timestamp").alias("available_from"),
        F.when(digits("_h", 8, 1) > 0, F.when(touching, F.date_add(before, digits("_h", 5, 3) % 700 + 1)).otherwise(end("_h")))
         .cast("timestamp").alias("available_to"))


def with_recording(captures: DataFrame) -> DataFrame:
    """User captures with the time they became known: at once, or, drawn from an MD5 of (user, capture), three
    years later, after newer captures."""
    late = F.substring(F.md5(F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("capture_ts", "yyyy-MM-dd"))), 1, 1) < "4"
    return captures.withColumn("recorded_ts", F.when(late, F.col("capture_ts") + F.expr("INTERVAL 1095 DAYS")).otherwise(F.col("capture_ts")))
