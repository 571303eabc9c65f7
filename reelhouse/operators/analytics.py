"""Analyst queries over the gold tables (F1-F8).

Thresholds are parameters (the reference's 1000 / 500 suit 25M ratings).
Every top-k has a total order (unique tie-breaker last) so the chosen rows
do not depend on partitioning.  Means are exact where the inputs allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.functions.exact import exact_mean

# Cohort bounds (casual < 10 <= moderate <= 50 < power).
CASUAL_BELOW = 10
MODERATE_UP_TO = 50


def _fact_mean(col: str = "rating_value"):
    # one-decimal values summed as whole tenths: a BIGINT holds 10**18 of them
    tenths = F.sum((F.col(col) * 10).cast("long"))
    return exact_mean(tenths.cast("decimal(20,0)") / F.lit(10), F.count(F.lit(1)))


def top_titles(mart: DataFrame, min_ratings: int = 1000, k: int = 10) -> DataFrame:
    """F1: best weighted score among titles with enough ratings."""
    return (mart.filter(F.col("total_ratings") >= min_ratings)
            .orderBy(F.col("weighted_score").desc_nulls_last(), F.col("total_ratings").desc(),
                     F.col("movie_id").asc())
            .limit(k)
            .select("title", "primary_genre", "era", "avg_rating", "total_ratings", "weighted_score"))


def rating_trend_yoy(fact: DataFrame) -> DataFrame:
    """yearly mean and count with the change to the previous year.

    The lag runs over the yearly aggregate (one row per year), so its
    un-partitioned window sees only a handful of rows."""
    yearly = fact.groupBy("rating_year").agg(_fact_mean().alias("avg_rating"),
                                             F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("rating_year")
    return (yearly.select("rating_year", "avg_rating", "n",
                          (F.col("avg_rating") - F.lag("avg_rating").over(w)).alias("yoy_delta"))
            .orderBy("rating_year"))


def _title_mean_of(col: str):
    # mean of a DECIMAL(4,2) column: exact decimal sum, one division
    return exact_mean(F.sum(col), F.count(col))


def genre_popularity(mart: DataFrame) -> DataFrame:
    """ratings, mean of title means and titles per primary genre."""
    return (mart.groupBy("primary_genre")
            .agg(F.sum("total_ratings").alias("total_ratings"),
                 _title_mean_of("avg_rating").alias("avg_rating_across_titles"),
                 F.count(F.lit(1)).alias("title_count"))
            .orderBy(F.col("total_ratings").desc(), F.col("primary_genre").asc_nulls_last()))


def tier_behavior(fact: DataFrame) -> DataFrame:
    """mean rating, count and share positive per tier at rating time."""
    return (fact.groupBy(F.col("membership_tier_at_rating").alias("tier"))
            .agg(_fact_mean().alias("avg_rating"),
                 F.count(F.lit(1)).alias("rating_count"),
                 exact_mean(F.count_if(F.col("is_positive")), F.count(F.lit(1))).alias("pct_positive"))
            .orderBy(F.col("rating_count").desc(), F.col("tier").asc_nulls_last()))


def tier_behavior_from_histogram(hist: DataFrame, tiers=("basic", "standard", "premium")) -> DataFrame:
    """F4 from the mart's (title, rating value) histogram instead of the fact.

    The histogram carries per-tier counts for each value, so count, exact sum
    and positive share per tier follow exactly; it holds at most 46 rows per
    title, so this reads a tiny table where the fact-based form scans every
    rating.  Tiers are the staged domain (``basic``, ``standard``,
    ``premium``)."""
    per_tier = hist.select(
        "rating_value",
        F.explode(F.array(*[F.struct(F.lit(t).alias("tier"), F.col(f"n_{t}").alias("n")) for t in tiers]))
        .alias("t")).select("rating_value", "t.tier", "t.n")
    positive = F.col("rating_value") >= F.lit(3.5).cast("decimal(3,1)")
    return (per_tier.groupBy("tier")
            .agg(F.sum("n").alias("rating_count"),
                 F.sum(F.col("rating_value") * F.col("n")).alias("_sum"),
                 F.sum(F.when(positive, F.col("n")).otherwise(F.lit(0))).alias("_pos"))
            .filter(F.col("rating_count") > 0)
            .select("tier", exact_mean(F.col("_sum"), F.col("rating_count")).alias("avg_rating"),
                    "rating_count", exact_mean(F.col("_pos"), F.col("rating_count")).alias("pct_positive"))
            .orderBy(F.col("rating_count").desc(), F.col("tier").asc_nulls_last()))


def era_analysis(mart: DataFrame) -> DataFrame:
    """mean of title means, ratings and titles per era."""
    return (mart.groupBy("era")
            .agg(_title_mean_of("avg_rating").alias("era_avg_rating"),
                 F.sum("total_ratings").alias("era_ratings"),
                 F.count(F.lit(1)).alias("title_count"))
            .orderBy(F.col("era_ratings").desc(), F.col("era").asc_nulls_last()))


def user_cohorts(fact: DataFrame, casual_below: int = CASUAL_BELOW,
                 moderate_up_to: int = MODERATE_UP_TO) -> DataFrame:
    """users (user versions, as the reference keys them) by activity.

    Two partial aggregations; the mean of user means is rounded to 6 decimals
    because a sum of arbitrary doubles depends on arrival order."""
    per_user = fact.groupBy("user_sk").agg(F.count(F.lit(1)).alias("n_ratings"),
                                           _fact_mean().alias("avg_rating"))
    cohort = (F.when(F.col("n_ratings") < casual_below, "casual")
              .when(F.col("n_ratings") <= moderate_up_to, "moderate").otherwise("power"))
    return (per_user.groupBy(cohort.alias("cohort"))
            .agg(F.count(F.lit(1)).alias("users"),
                 F.round(F.avg("avg_rating"), 6).alias("avg_user_rating"),
                 exact_mean(F.sum("n_ratings"), F.count(F.lit(1))).alias("avg_n_ratings"))
            .orderBy("cohort"))


def controversial_titles(mart: DataFrame, min_stddev: float = 1.5, min_ratings: int = 500,
                         k: int = 20) -> DataFrame:
    """most spread-out ratings among titles with enough ratings."""
    return (mart.filter((F.col("rating_stddev") > min_stddev) & (F.col("total_ratings") >= min_ratings))
            .orderBy(F.col("rating_stddev").desc(), F.col("total_ratings").desc(), F.col("movie_id").asc())
            .limit(k)
            .select("title", "primary_genre", "total_ratings", "avg_rating", "rating_stddev"))


def tier_change_history(dim_user: DataFrame, k: int = 20) -> DataFrame:
    """F8: users with more than one version, their tiers in time order.

    Users are ranked by version count first (partial aggregation, then a
    top-k); tier lists are collected only for the k chosen users, whose keys
    form a broadcast side of at most k rows."""
    counts = (dim_user.groupBy("user_id").agg(F.count(F.lit(1)).alias("rows_in_dim_user"))
              .filter(F.col("rows_in_dim_user") > 1))
    top = counts.orderBy(F.col("rows_in_dim_user").desc(), F.col("user_id").asc()).limit(k)
    lists = (dim_user.join(F.broadcast(top.select("user_id")), "user_id")
             .groupBy("user_id")
             .agg(F.array_sort(F.collect_list(F.struct("valid_from", "membership_tier"))).alias("_h")))
    return (top.join(lists, "user_id")
            .select("user_id", F.transform("_h", lambda x: x["membership_tier"]).alias("tier_history"),
                    "rows_in_dim_user")
            .orderBy(F.col("rows_in_dim_user").desc(), F.col("user_id").asc()))
