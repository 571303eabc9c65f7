import datetime as dt
import random
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from reelhouse.functions.exact import half_up_ratio
from reelhouse.functions.scoring import bayesian_score
from reelhouse.operators import dims, mart


def test_dim_date_default_and_attributes(spark):
    d = dims.dim_date(spark)
    assert d.count() == 11323
    rows = {r.full_date: r for r in d.filter(F.col("full_date").isin(
        dt.date(2000, 2, 29), dt.date(2023, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 12, 31))).collect()}
    assert rows[dt.date(2000, 2, 29)].is_leap_year and rows[dt.date(2000, 2, 29)].days_in_month == 29
    assert rows[dt.date(2023, 1, 1)].week_of_year == 0
    assert rows[dt.date(2024, 1, 1)].week_of_year == 1
    assert rows[dt.date(2024, 12, 31)].week_of_year == 53
    mon = rows[dt.date(2024, 1, 1)]
    assert mon.day_of_week == 7 and mon.iso_day_of_week == 1 and mon.day_name == "Monday"
    assert mon.date_sk == 20240101 and mon.quarter_name == "Q1" and mon.month_short == "Jan"
    sun = rows[dt.date(2023, 1, 1)]
    assert sun.is_weekend and sun.day_of_week == 6 and sun.iso_day_of_week == 7
    y1900 = dims.dim_date(spark, "1900-02-01", "1900-02-28").first()
    assert not y1900.is_leap_year and y1900.days_in_month == 28


def test_half_up_ratio_exact(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randint(0, 10 ** 12), rnd.randint(1, 10 ** 9)) for _ in range(300)]
    pairs += [(1206, 400), (122, 80), (5, 200), (0, 3)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", half_up_ratio(F.col("n"), F.col("d"), 38, 2).alias("q")).collect()
    for r in got:
        want = (Decimal(r.n) / Decimal(r.d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) \
            if r.d else None
        assert r.q == want


def _fact(spark, rows):
    return spark.createDataFrame(
        [(c, u, Decimal(str(v)), v >= 3.5, dt.datetime(2000, 1, 1), "basic") for c, u, v in rows],
        "content_sk string, user_sk string, rating_value decimal(3,1), is_positive boolean, "
        "rated_at timestamp, membership_tier_at_rating string")


def test_title_stats_edges(spark):
    f = _fact(spark, [("one", "u1", 4.0), ("two", "u1", 3.5), ("two", "u2", 4.0),
                      ("odd", "u1", 1.0), ("odd", "u1", 2.0), ("odd", "u3", 5.0)])
    du = spark.createDataFrame([("u1", "NA"), ("u2", "EU"), ("u3", "NA")], "user_sk string, region string")
    st = {r.content_sk: r for r in mart.title_stats(f, du).collect()}
    assert st["one"].rating_stddev is None and st["one"].median_rating == Decimal("4.00")
    assert st["two"].median_rating == Decimal("3.75") and st["two"].avg_rating == Decimal("3.75")
    assert st["two"].unique_regions == 2 and st["odd"].unique_raters == 2
    assert st["odd"].median_rating == Decimal("2.00") and st["odd"].avg_rating == Decimal("2.67")
    assert st["odd"].pct_positive == Decimal("33.33") and st["odd"].rating_stddev == Decimal("2.08")


def test_bayesian_score_edges(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 5.0), (10 ** 6, 4.0 * 10 ** 6)], "n long, total double")
    got = [r.s for r in df.select(bayesian_score(F.col("n"), F.col("total"), F.lit(10.0), F.lit(3.0))
                                  .alias("s")).collect()]
    assert got[0] == 3.0
    assert 3.0 < got[1] < 5.0
    assert abs(got[2] - 4.0) < 1e-4
    zero = spark.createDataFrame([(0, 0.0)], "n long, total double").select(
        bayesian_score(F.col("n"), F.col("total"), F.lit(0.0), F.lit(3.0)).alias("s")).first().s
    assert zero is None


def test_score_between_prior_and_title_mean(spark):
    from reelhouse.plans.gold import GoldBuild
    g = GoldBuild(spark, "/root/testdata/sf0.001")
    m = g.mart
    prior = mart.global_prior(g.histogram).first()
    bad = m.filter(~(F.col("weighted_score").cast("double").between(
        F.least(F.lit(prior.prior_mean), F.col("avg_rating").cast("double")) - 0.006,
        F.greatest(F.lit(prior.prior_mean), F.col("avg_rating").cast("double")) + 0.006))).count()
    assert bad == 0


def test_stats_exact_for_any_tenth(spark):
    import statistics
    vals = [3.3, 4.1, 0.7, 5.0, 2.9]
    f = _fact(spark, [("t", f"u{i}", v) for i, v in enumerate(vals)])
    du = spark.createDataFrame([(f"u{i}", "NA") for i in range(5)], "user_sk string, region string")
    r = mart.title_stats(f, du).first()
    want = Decimal(str(statistics.stdev(vals))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert r.rating_stddev == want
    assert r.avg_rating == (Decimal("16.0") / 5).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert r.median_rating == Decimal("3.30")


def test_audience_pairs_move_once_to_the_users(spark):
    fact = spark.createDataFrame([("t", "v"), ("t", "v"), ("t", "w"), ("s", None), ("s", "gone")], "content_sk string, user_sk string")
    users = spark.createDataFrame([("v", "NA"), ("w", "NA")], "user_sk string, region string")
    got = mart.title_audience(fact, users.hint("merge"))
    assert sorted(map(tuple, got.collect())) == [("s", 1, 0), ("t", 2, 1)]
    assert "hashpartitioning(content_sk, user_sk" not in re.sub(r"#\d+L?", "", got._jdf.queryExecution().executedPlan().toString())
