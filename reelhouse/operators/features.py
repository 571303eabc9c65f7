"""Feature tables for machine learning (H1-H4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.keys import surrogate_key


def content_features(stg_movies: DataFrame) -> DataFrame:
    """H1: one row per (title, genre) with the genre's position - the long
    form of genre indicators - plus year and era.  Taken from the staged titles,
    whose genres are still an array (no join needed)."""
    return (stg_movies
            .select(surrogate_key("movie_id").alias("content_sk"), "movie_id", "release_year", "era", "genre_count",
                    F.posexplode("genres_array").alias("genre_pos", "genre")))


def user_item_ratings(fact: DataFrame, dim_user: DataFrame, dim_content: DataFrame) -> DataFrame:
    """H2: (user_id, movie_id, rating, rated_at) for matrix factorization
    (e.g. ``pyspark.ml.recommendation.ALS``).  The fact carries surrogate keys
    only, so both dimensions are joined back on their keys."""
    users = dim_user.select("user_sk", "user_id")
    content = dim_content.select("content_sk", "movie_id")
    return (fact.select("user_sk", "content_sk", "rating_value", "rated_at")
            .join(users, "user_sk").join(content, "content_sk")
            .select(F.col("user_id").cast("long").alias("user_id"),
                    F.col("movie_id").cast("long").alias("movie_id"),
                    F.col("rating_value").cast("double").alias("rating"), "rated_at"))


def engagement_features(mart: DataFrame) -> DataFrame:
    """H3: per-title engagement from the mart."""
    return mart.select("content_sk", "movie_id", "total_ratings", "avg_rating", "pct_positive",
                       "unique_raters", "weighted_score")


def recency_features(fact: DataFrame) -> DataFrame:
    """H4: days since release at fact grain."""
    return fact.select("rating_sk", "user_sk", "content_sk", "rated_at", "days_since_release")
