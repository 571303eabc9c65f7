"""Ratings at many grains: a cube, rolling means, and mergeable sketches.

Each starts from one reduction of the fact whose size does not grow with a title's ratings, and
never reads the fact again: the cube from its finest cells, rolling means from one row per
title and day, yearly and genre figures from stored monthly sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.functions.exact import exact_mean

CUBE_DIMS = ("era", "primary_genre", "membership_tier", "rating_year")
ROLLING_DAYS = (7, 30, 90)

# Fixed values of the sketches: 2**LG_K registers, and quantiles from QUANTILE_K kept values.
LG_K = 12
QUANTILE_K = 400
#: Bounds that estimates keep to: three standard errors of the distinct count, and the rank error
#: of the quantiles at that k.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.015


# --- cube -----------------------------------------------------------------------------------
def rating_cube(fact: DataFrame, dim_content: DataFrame, dims: Sequence[str] = CUBE_DIMS) -> DataFrame:
    """Ratings at every combination of ``dims``: dims (null where rolled up), ``grain`` (bit i, from the
    right, set if the i-th last dimension is rolled up), n_ratings, avg_rating, n_positive.

    The fact is first reduced to (title, tier, year), so a hot title never travels, then to
    the finest cells; the other grains are sums of these cells."""
    x10 = (F.col("rating_value") * 10).cast("long")
    sums = {"n_ratings": F.count(F.lit(1)), "_s10": F.sum(x10), "n_positive": F.count_if("is_positive")}
    per_title = (fact.withColumnRenamed("membership_tier_at_rating", "membership_tier")
                 .groupBy("content_sk", "membership_tier", "rating_year").agg(*[e.alias(n) for n, e in sums.items()]))
    again = [F.sum(n).alias(n) for n in sums]
    cells = per_title.join(dim_content.select("content_sk", "era", "primary_genre"), "content_sk").groupBy(*dims).agg(*again)
    return cells.cube(*dims).agg(F.grouping_id().alias("grain"), *again).select(
        *dims, "grain", "n_ratings", exact_mean(F.col("_s10"), F.col("n_ratings") * 10).alias("avg_rating"), "n_positive")


# --- rolling means ----------------------------------------------------------------------------
def title_days(fact: DataFrame) -> DataFrame:
    """(content_sk, day, n_ratings, s10): one row per title and day with a rating, s10 ten times the sum."""
    return fact.groupBy("content_sk", F.to_date("rated_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n_ratings"), F.sum((F.col("rating_value") * 10).cast("long")).alias("s10"))


def rolling_means(days: DataFrame, spans: Sequence[int] = ROLLING_DAYS) -> DataFrame:
    """For each title and day with a rating: count and mean over the last 7, 30 and 90 days, that day
    included (calendar days, not rows).

    The frames run over :func:`title_days`, where a title has one row per day of the
    calendar at most, however hot it is."""
    w = Window.partitionBy("content_sk").orderBy(F.unix_date("day"))
    out = days
    for span in spans:
        frame = w.rangeBetween(-(span - 1), 0)
        n, s10 = F.sum("n_ratings").over(frame), F.sum("s10").over(frame)
        out = out.withColumns({f"n_{span}d": n, f"mean_{span}d": exact_mean(s10, n * 10)})
    return out.drop("s10")


# --- sketches -----------------------------------------------------------------------------------
def viewer_sketches(fact: DataFrame, dim_user: DataFrame, by: Sequence[str] = ("content_sk", "rating_year", "rating_month")) -> DataFrame:
    """Sketches per title and month, to be stored: ``viewers`` (distinct users, not user versions) and
    ``ages`` (days from release to rating), with the exact n_ratings.  Both are built by
    partial aggregation; a sketch has a fixed size however many ratings it has seen."""
    users = fact.join(dim_user.select("user_sk", "user_id"), "user_sk")
    return users.groupBy(*by).agg(F.hll_sketch_agg("user_id", LG_K).alias("viewers"),
                                  F.kll_sketch_agg_bigint(F.col("days_since_release").cast("long"), F.lit(QUANTILE_K)).alias("ages"),
                                  F.count(F.lit(1)).alias("n_ratings"))


def merged_sketches(sketches: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The stored sketches merged to a coarser grain, without the fact."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("viewers").alias("viewers"),
                                     F.kll_merge_agg_bigint("ages").alias("ages"), F.sum("n_ratings").alias("n_ratings"))


def sketch_estimates(sketches: DataFrame) -> DataFrame:
    """Sketches read: ``n_viewers`` estimated, ``median_age``."""
    return sketches.select(*[c for c in sketches.columns if c not in ("viewers", "ages")],
                           F.hll_sketch_estimate("viewers").alias("n_viewers"),
                           F.kll_sketch_get_quantile_bigint("ages", F.lit(0.5)).alias("median_age"))


def sketch_check(fact: DataFrame, dim_user: DataFrame, dim_content: DataFrame) -> DataFrame:
    """Monthly title sketches merged up to (genre, year) against exact figures: n_ratings, the exact n_viewers,
    and whether the estimate and the rank of the estimated median keep to their bounds."""
    by = ["primary_genre", "rating_year"]
    genre = dim_content.select("content_sk", "primary_genre")
    merged = sketch_estimates(merged_sketches(viewer_sketches(fact, dim_user).join(genre, "content_sk"), by))
    rows = fact.join(genre, "content_sk").join(dim_user.select("user_sk", "user_id"), "user_sk")
    viewers = rows.select(*by, "user_id").distinct().groupBy(*by).agg(F.count("*").alias("exact"))
    age = F.col("days_since_release")
    ranks = (rows.join(merged.select(*by, "median_age"), by).groupBy(*by)
             .agg(F.count_if(age < F.col("median_age")).alias("_below"), F.count_if(age <= F.col("median_age")).alias("_upto"),
                  F.count(age).alias("_n")))
    near = F.abs(F.col("n_viewers") - F.col("exact")) <= F.ceil(F.col("exact") * DISTINCT_ERROR)
    half = (F.col("_below") <= F.ceil(F.col("_n") * (0.5 + RANK_ERROR))) & (F.col("_upto") >= F.floor(F.col("_n") * (0.5 - RANK_ERROR)))
    return merged.join(viewers, by).join(ranks, by).select(
        *by, "n_ratings", F.col("exact").alias("n_viewers"), near.alias("viewers_within"), half.alias("median_within"))
