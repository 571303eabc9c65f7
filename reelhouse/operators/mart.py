"""Per-title mart with a Bayesian-weighted score.

Plan: the fact is reduced twice with map-side partial aggregation and never
joined row-by-row to the user dimension:

1. a histogram per (title, rating value): a title has at most 46 distinct
   values, so this is at most 46 rows per title whatever the number of
   ratings; count, sum, median, stddev, tier counts and dates all derive from
   it exactly, and so does the prior (E1);
2. the distinct (title, user version) pairs: only these are joined to the user
   dimension (for the region), since the region count needs no more.

A hot title (a third of all ratings) therefore never reaches one task with its
raw rows: partial aggregation collapses it to <= 46 rows per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.exact import exact_mean, half_up_ratio, sample_stddev_from_sums
from reelhouse.functions.keys import key_columns, packed, packed_keys, unpacked_keys
from reelhouse.functions.scoring import bayesian_score

# Fixed values.
TIER_NAMES = ("basic", "standard", "premium")
PRIOR_KINDS = ("value_bucket", "title")


def rating_histogram(fact: DataFrame) -> DataFrame:
    """(content_sk, rating_value) -> n, n_positive, per-tier counts, first/last time."""
    tier = F.col("membership_tier_at_rating")
    key = fact.select("content_sk")
    hist = (fact.withColumns({c: packed(c) for c in key_columns(key)}).groupBy("content_sk", "rating_value")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("is_positive")).alias("n_positive"),
                 *[F.count_if(tier == t).alias(f"n_{t}") for t in TIER_NAMES],
                 F.min("rated_at").alias("first_at"),
                 F.max("rated_at").alias("last_at")))
    return unpacked_keys(hist, key_columns(key))


def global_prior(hist: DataFrame, prior: str = "value_bucket") -> DataFrame:
    """One row (prior_mean m, prior_count C).

    ``value_bucket`` (the reference as coded): over the (title, value) groups,
    m = mean of the group values, C = mean group size.
    ``title``: m = mean of the titles' mean ratings, C = mean ratings per title.
    Means are exact sums over one division."""
    if prior not in PRIOR_KINDS:
        raise ValueError(f"prior must be one of {PRIOR_KINDS}")
    if prior == "value_bucket":
        return hist.agg(exact_mean(F.sum("rating_value"), F.count(F.lit(1))).alias("prior_mean"),
                        exact_mean(F.sum("n"), F.count(F.lit(1))).alias("prior_count"))
    per_title = hist.groupBy("content_sk").agg(
        exact_mean(F.sum(F.col("rating_value") * F.col("n")), F.sum("n")).alias("title_mean"),
        F.sum("n").alias("n"))
    return per_title.agg(F.avg("title_mean").alias("prior_mean"),
                         exact_mean(F.sum("n"), F.count(F.lit(1))).alias("prior_count"))


def title_rating_stats(hist: DataFrame) -> DataFrame:
    """Count, exact sum, mean, median, % positive, stddev, tiers, dates per title."""
    x10 = (F.col("rating_value") * 10).cast("long")       # exact: DECIMAL(3,1) in tenths
    agg = hist.groupBy("content_sk").agg(
        F.sum("n").alias("total_ratings"),
        F.sum(x10 * F.col("n")).alias("_s10"),
        F.sum(x10 * x10 * F.col("n")).alias("_s2"),
        F.percentile(F.col("rating_value").cast("double"), F.lit(0.5), F.col("n")).alias("_median"),
        F.sum("n_positive").alias("_pos"),
        *[F.sum(f"n_{t}").alias(f"{t}_tier_ratings") for t in TIER_NAMES],
        F.min("first_at").alias("_first"),
        F.max("last_at").alias("_last"))
    return agg.select(
        "content_sk", "total_ratings",
        (F.col("_s10").cast("decimal(38,1)") / 10).cast("double").alias("rating_sum"),
        half_up_ratio(F.col("_s10"), F.col("total_ratings") * 10, 4, 2).alias("avg_rating"),
        F.col("_median").cast("decimal(4,2)").alias("median_rating"),
        half_up_ratio(F.col("_pos") * 100, F.col("total_ratings"), 5, 2).alias("pct_positive"),
        sample_stddev_from_sums(F.col("total_ratings"), F.col("_s10"), F.col("_s2"), unit=10)
         .cast("decimal(4,2)").alias("rating_stddev"),
        F.to_date("_first").alias("first_rated_at"),
        F.to_date("_last").alias("last_rated_at"),
        *[f"{t}_tier_ratings" for t in TIER_NAMES])


def title_audience(fact: DataFrame, dim_user: DataFrame) -> DataFrame:
    """D3 + distinct counts: unique user versions and regions per title.

    Distinct (title, user version) pairs are formed first, hashed on the user
    version: a hot title spreads over many tasks, and only they meet the user dimension in a
    left join on ``user_sk`` without being moved again.  Keys are packed until the end.  The rows of a hot user version meet in one task, which
    keeps a pair per title."""
    pairs = packed_keys(fact.select("content_sk", "user_sk")).repartition("user_sk").distinct()
    audience = (pairs.join(packed_keys(dim_user.select("user_sk", "region")), "user_sk", "left")
                .groupBy("content_sk")
                .agg(F.count("user_sk").alias("unique_raters"),
                     F.count_distinct("region").alias("unique_regions")))
    return unpacked_keys(audience, key_columns(fact.select("content_sk")))


def title_stats(fact: DataFrame, dim_user: DataFrame, hist: DataFrame | None = None,
                audience: DataFrame | None = None) -> DataFrame:
    """All per-title statistics of the mart (before the score).  ``hist``
    and ``audience`` may be given pre-computed (e.g. written tables)."""
    hist = rating_histogram(fact) if hist is None else hist
    audience = title_audience(fact, dim_user) if audience is None else audience
    return title_rating_stats(hist).join(audience, "content_sk", "left")


def with_prior(stats: DataFrame, prior_row: DataFrame) -> DataFrame:
    """The one-row prior beside every title, as scalar subqueries of the plan: no
    join, and nothing runs while the plan is built."""
    return stats.withColumns({c: prior_row.select(c).scalar() for c in ("prior_mean", "prior_count")})


def mart_content_performance(fact: DataFrame, dim_content: DataFrame, dim_user: DataFrame,
                             prior: str = "value_bucket", hist: DataFrame | None = None,
                             audience: DataFrame | None = None) -> DataFrame:
    """One row per rated title with the Bayesian-weighted score.

    Pass ``hist`` (e.g. the written histogram) so that statistics and prior (E1) read
    that instead of the fact."""
    hist = rating_histogram(fact) if hist is None else hist
    stats = with_prior(title_stats(fact, dim_user, hist, audience), global_prior(hist, prior))
    content = dim_content.select("content_sk", "movie_id", "title", "release_year", "era", "primary_genre",
                                 "all_genres")
    score = bayesian_score(F.col("total_ratings"), F.col("rating_sum"), F.col("prior_count"), F.col("prior_mean"))
    return stats.join(content, "content_sk").select(
        "content_sk", "movie_id", "title", "release_year", "era", "primary_genre", "all_genres",
        "total_ratings", "avg_rating", "median_rating", "pct_positive", "rating_stddev",
        "first_rated_at", "last_rated_at", "unique_raters", "unique_regions",
        *[f"{t}_tier_ratings" for t in TIER_NAMES],
        score.cast("decimal(6,4)").alias("weighted_score"))
