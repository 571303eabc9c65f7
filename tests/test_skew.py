"""A user holding a third of all ratings: the as-of join stays keyed and AQE
splits the hot partition of the sort-merge join."""

import datetime as dt

from pyspark.sql import functions as F

from reelhouse.operators import facts


def test_hot_user_as_of_join_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        ev = (spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("user_id"),
            (F.lit(dt.datetime(2000, 1, 1)).cast("timestamp") + F.make_interval(secs=F.col("id") * 1000))
            .alias("rated_at"), F.col("id")))
        versions = F.array(
            F.struct(F.lit(dt.datetime(1900, 1, 1)).alias("valid_from"),
                     F.lit(dt.datetime(2000, 6, 1)).alias("valid_to"), F.lit("basic").alias("membership_tier")),
            F.struct(F.lit(dt.datetime(2000, 6, 1)).alias("valid_from"),
                     F.lit(dt.datetime(9999, 12, 31)).alias("valid_to"), F.lit("premium").alias("membership_tier")))
        users = (spark.range(998).select(
            F.when(F.col("id") == 997, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("user_id"),
            F.explode(versions).alias("v")).select("user_id", "v.*"))
        joined = facts.rating_as_of(ev, users, "user_id", "rated_at")
        rows = joined.groupBy("membership_tier").count().collect()
        assert sum(r["count"] for r in rows) == n
        out = joined.select(F.sum("id"))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
