import datetime as dt
import os

from pyspark.sql import functions as F

from reelhouse.operators import quality
from reelhouse.sources import counts, files, sinks, synth


def test_row_checks_clean_and_dirty(spark):
    clean = spark.createDataFrame([(1, "a", 3.0), (2, "b", 4.5)], "id long, tier string, v double")
    dirty = spark.createDataFrame([(1, "a", 3.0), (1, "gold", 5.5), (None, None, 0.5)],
                                  "id long, tier string, v double")
    assert quality.check_not_null(clean, "id").count() == 0
    assert quality.check_not_null(dirty, "id").count() == 1
    assert quality.check_unique(clean, "id").count() == 0
    assert quality.check_unique(dirty, "id").first().n == 2
    assert quality.check_accepted_values(clean, "tier", ["a", "b"]).count() == 0
    assert quality.check_accepted_values(dirty, "tier", ["a", "b"]).count() == 1   # null passes
    assert quality.check_rating_range(clean, "v", keep=("id",)).count() == 0
    assert quality.check_rating_range(dirty, "v", keep=("id",)).count() == 1
    parent = spark.createDataFrame([(1,)], "id long")
    assert quality.check_relationships(dirty, "id", parent).count() == 0
    assert quality.check_relationships(clean, "id", parent).count() == 1


def test_scalar_checks_and_report(spark):
    df = spark.createDataFrame([(i, float(i % 5) + 0.5, None if i == 3 else "x") for i in range(10)],
                               "id long, v double, s string")
    checks = [quality.RowCountCheck(5, 20), quality.RowCountCheck(20, 30), quality.NullRateCheck("s", 0.0),
              quality.NullRateCheck("s", 0.2), quality.RangeCheck("v", 0.5, 5.0), quality.RangeCheck("v", 1.0, 2.0),
              quality.UniquenessCheck("id", 0.0), quality.UniquenessCheck("s", 0.0),
              quality.DistributionCheck("v", 2.5, 1.0), quality.DistributionCheck("v", 100.0, 1.0),
              quality.SchemaCheck({"id": "bigint", "v": "double"}), quality.SchemaCheck({"id": "int"}),
              quality.NullRateCheck("missing", 0.0)]
    rep = quality.quality_report(df, checks).collect()
    assert [r.status for r in rep] == ["pass", "fail", "fail", "pass", "pass", "fail", "pass", "fail",
                                       "pass", "fail", "pass", "fail", "error", "fail"]
    assert rep[-1].check == "overall" and rep[-1].message == "rows=10"
    ok = quality.quality_report(df, checks[:1]).collect()
    assert ok[-1].status == "pass"


def test_contract_violations(spark):
    fact = spark.createDataFrame([("r1", "u1", "c1", 1, 3.0), ("r1", None, "c9", 2, 4.0)],
                                 "rating_sk string, user_sk string, content_sk string, date_sk int, rating_value double")
    dim_content = spark.createDataFrame([("c1", "1", 1999, "modern", "x")],
                                        "content_sk string, movie_id string, release_year int, era string, primary_genre string")
    out = {(r.table, r.column, r.test): r.violations for r in
           quality.contract_violations({"fact_viewership": fact, "dim_content": dim_content}).collect()}
    assert out[("fact_viewership", "rating_sk", "unique")] == 1
    assert out[("fact_viewership", "user_sk", "not_null")] == 1
    assert out[("fact_viewership", "content_sk", "relationships")] == 1
    assert out[("dim_content", "era", "accepted_values")] == 0


def test_csv_scans_roundtrip(spark, tmp_dir):
    movies = spark.createDataFrame([(7789, '11\'09""01 - September 11, part "two" (2002)', "Drama|War"),
                                    (1, "Toy Story (1995)", "Animation")],
                                   "movieId long, title string, genres string")
    files.write_csv(movies.coalesce(1), tmp_dir + "/movies")
    back = {r.movieId: r for r in files.scan_movies(spark, tmp_dir + "/movies").collect()}
    assert back[7789].title == '11\'09""01 - September 11, part "two" (2002)'
    assert back[7789].genres == "Drama|War"
    path = os.path.join(tmp_dir, "users.csv")
    with open(path, "w") as fh:
        fh.write("user_id,membership_tier,region,device_preference,created_at\n"
                 "1,basic,NA,tv,2020-01-02\n2,premium,EU,mobile,\n")
    users = {r.user_id: r for r in files.scan_users(spark, path).collect()}
    assert users[1].region == "NA" and users[1].created_at == dt.date(2020, 1, 2)
    assert users[2].created_at is None
    stamped = files.load_stamp(files.scan_users(spark, path), "2026-01-01 00:00:00").first()
    assert stamped._loaded_at == dt.datetime(2026, 1, 1)


def test_source_row_counts_missing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.csv")
    with open(path, "w") as fh:
        fh.write("userId,movieId,rating,timestamp\n1,2,3.5,100\n1,3,4.0,200\n")
    out = dict(counts.source_row_counts(spark, {
        "ratings": (files.scan_ratings, path),
        "movies": (files.scan_movies, os.path.join(tmp_dir, "nope.csv"))}).collect())
    assert out == {"ratings": 2, "movies": 0}


def test_synthesize_users(spark):
    a = synth.synthesize_users(spark, 20000, seed=42, num_partitions=3)
    b = synth.synthesize_users(spark, 20000, seed=42, num_partitions=7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    shares = {r.membership_tier: r["count"] / 20000 for r in a.groupBy("membership_tier").count().collect()}
    assert abs(shares["basic"] - 0.3) < 0.02 and abs(shares["standard"] - 0.4) < 0.02
    regions = {r.region: r["count"] / 20000 for r in a.groupBy("region").count().collect()}
    assert abs(regions["LATAM"] - 0.1) < 0.02
    lo, hi = a.agg(F.min("created_at"), F.max("created_at")).first()
    assert lo >= dt.date(2015, 1, 1) and hi <= dt.date(2024, 12, 31)


def test_write_gold_partition_pruning_and_audit(spark, tmp_dir):
    df = spark.createDataFrame([(i, 1995 + i % 5, float(i)) for i in range(50)],
                               "id long, rating_year int, v double")
    path = sinks.write_gold(df, tmp_dir + "/fact", "rating_year")
    pruned = sinks.read_gold_pruned(spark, path, [1996, 1997])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [rating_year" in plan and "IN (1996,1997)" in plan
    assert pruned.count() == 20
    cnt = spark.createDataFrame([("ratings", 10), ("movies", 3)], "source string, n long")
    rep = quality.quality_report(df, [quality.RowCountCheck(1, 100)])
    a1 = sinks.append_run_audit(spark, tmp_dir + "/audit", "run-1", cnt, rep, "2026-01-01 00:00:00")
    a2 = sinks.append_run_audit(spark, tmp_dir + "/audit", "run-2", None, None, "2026-01-02 00:00:00")
    rows = {r.run_id: r for r in a2.collect()}
    assert a1.count() == 1 and len(rows) == 2
    assert rows["run-1"].status == "pass" and rows["run-1"].seed_ratings_rows == 10
    assert rows["run-1"].gold_mart_rows == 50 and rows["run-1"].seed_tags_rows == 0
    assert rows["run-2"].status == "unknown" and rows["run-2"].observe_status == "unknown"
