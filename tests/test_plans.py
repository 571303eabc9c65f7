"""Plan shape: no cartesian products, pruned scans, pushed filters."""

from reelhouse.plans.gold import GoldBuild

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_is_keyed(spark):
    p = _plan(GoldBuild(spark, SF).fact)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_mart_plan_has_no_cross_join(spark):
    p = _plan(GoldBuild(spark, SF).mart)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Expand" not in p


def test_hot_user_is_split_on_the_written_dimension(spark, tmp_dir):
    """The fact of the pipeline: dim_user read back from Parquet, one user with most ratings."""
    from pyspark.sql import functions as F

    from reelhouse.operators import facts
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    g = GoldBuild(spark, SF)
    g.dim_user.write.parquet(tmp_dir + "/dim_user")
    hot = g.dim_user.select("user_id").orderBy("user_id").first().user_id
    ratings = g.stg_ratings.withColumn("user_id", F.when(F.rand(3) < 0.5, hot).otherwise(F.col("user_id")))
    ratings.write.parquet(tmp_dir + "/ratings")
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = facts.fact_viewership(spark.read.parquet(tmp_dir + "/ratings"), g.dim_content,
                                     spark.read.parquet(tmp_dir + "/dim_user"))
        fact.collect()
        assert "SortMergeJoin(skew=true)" in _plan(fact)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_contracts_read_the_written_fact_once(spark, tmp_dir):
    from reelhouse.operators import quality
    g = GoldBuild(spark, SF)
    tables = {"dim_content": g.dim_content, "dim_user": g.dim_user, "dim_date": g.dim_date, "fact_viewership": g.fact}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_dir}/{name}")
    p = _plan(quality.contract_violations({n: spark.read.parquet(f"{tmp_dir}/{n}") for n in tables}))
    assert sum("rating_sk" in line and "FileScan parquet" in line for line in p.splitlines()) == 1


def test_overlaps_do_not_need_a_reused_exchange(spark):
    from reelhouse.operators import history
    from reelhouse.plans.registry import dirty_versions
    d = dirty_versions(GoldBuild(spark, SF).dim_user)
    a = sorted(map(str, history.version_overlaps(d, num_partitions=16).collect()))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        b = sorted(map(str, history.version_overlaps(d, num_partitions=16).collect()))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert a == b and a


def test_filters_reach_scan(spark):
    g = GoldBuild(spark, SF)
    p = _plan(g.stg_ratings.filter("user_id = '5'"))
    assert "PushedFilters" in p


def test_top_k_and_aggregation_shapes(spark):
    from reelhouse.operators import analytics
    g = GoldBuild(spark, SF)
    tags = _plan(g.stg_tags)
    assert "HashAggregate" in tags and "Window" not in tags
    f8 = analytics.tier_change_history(g.dim_user)
    f8.collect()
    p = f8._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "TakeOrderedAndProject" in p
    top = analytics.top_titles(g.mart, min_ratings=20)
    top.collect()
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_size_shuffles_for(spark):
    from reelhouse.session import size_shuffles_for
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    try:
        n = size_shuffles_for(spark, 100 * 1024 ** 4)      # 100 TB
        assert n == 409600
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "409600"
    finally:
        if old is None:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        else:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", old)


def test_quality_report_scans_once(spark, tmp_dir):
    from reelhouse.operators import quality
    df = spark.range(1000).selectExpr("id", "id % 7 AS v", "CAST(id AS STRING) AS s")
    df.write.parquet(tmp_dir + "/t")
    t = spark.read.parquet(tmp_dir + "/t")
    rep = quality.quality_report(t, [quality.RowCountCheck(1, 10_000), quality.NullRateCheck("s", 0.0),
                                     quality.RangeCheck("v", 0, 6), quality.UniquenessCheck("id", 0.0)])
    rows = rep.collect()
    assert rows[-1].check == "overall" and rows[-1].status == "pass"
    final = rep._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1
