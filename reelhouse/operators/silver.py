"""Silver layer: typed, validated and de-duplicated views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.scoring import era_bucket

# Fixed values.
RATING_MIN, RATING_MAX = 0.5, 5.0
POSITIVE_FROM = 3.5
FIRST_FILM_YEAR = 1888
DEFAULT_CURRENT_YEAR = 2026
TIERS = ("basic", "standard", "premium")
DEFAULT_TIER = "standard"
YEAR_SUFFIX = r"\s*\(\d{4}\)\s*$"
YEAR_GROUP = r"\((\d{4})\)\s*$"


def stage_ratings(raw: DataFrame) -> DataFrame:
    """B1: ids as text, rating as DECIMAL(3,1), epoch -> timestamp, positive flag.

    The range test uses the raw double, the flag the rounded decimal."""
    value = F.col("rating").cast("decimal(3,1)")
    return (raw.filter(F.col("rating").between(RATING_MIN, RATING_MAX) & F.col("timestamp").isNotNull())
            .select(F.col("userId").cast("string").alias("user_id"),
                    F.col("movieId").cast("string").alias("movie_id"),
                    value.alias("rating_value"),
                    F.timestamp_seconds("timestamp").alias("rated_at"),
                    (value >= F.lit(POSITIVE_FROM).cast("decimal(3,1)")).alias("is_positive")))


def stage_movies(raw: DataFrame, current_year: int = DEFAULT_CURRENT_YEAR) -> DataFrame:
    """B2: year from a trailing '(dddd)', cleaned title, genre list, era."""
    year = F.regexp_extract("title", YEAR_GROUP, 1).try_cast("int")
    genres = F.split(F.col("genres"), r"\|")
    parsed = raw.select(F.col("movieId").cast("string").alias("movie_id"),
                        F.trim(F.regexp_replace("title", YEAR_SUFFIX, "")).alias("title_clean"),
                        F.col("title").alias("title_raw"),
                        year.alias("release_year"),
                        genres.alias("genres_array"))
    return (parsed.filter(F.col("release_year").isNotNull()
                          & F.col("release_year").between(FIRST_FILM_YEAR, current_year))
            .select("movie_id", "title_clean", "title_raw", "release_year", "genres_array",
                    F.get("genres_array", 0).alias("primary_genre"),
                    F.size("genres_array").alias("genre_count"),
                    era_bucket("release_year").alias("era")))


def stage_tags(raw: DataFrame) -> DataFrame:
    """Trim + lower, drop blank, newest row per (user, movie, tag).

    Every output column is a group key or the group's max time, so a partially
    aggregated ``groupBy`` replaces the reference's row_number window: no sort,
    and duplicates collapse map-side before the shuffle."""
    norm = F.trim(F.lower(F.col("tag")))
    return (raw.filter(F.col("tag").isNotNull() & (F.trim(F.col("tag")) != ""))
            .groupBy(F.col("userId").cast("string").alias("user_id"),
                     F.col("movieId").cast("string").alias("movie_id"),
                     norm.alias("tag_normalized"))
            .agg(F.timestamp_seconds(F.max("timestamp")).alias("tagged_at")))


def stage_users(raw: DataFrame) -> DataFrame:
    """Tier lower-cased, anything outside the accepted list (or null) becomes
    'standard' (no trim); created_at as DATE, also used as updated_at.

    Extra columns on the input (e.g. ``capture_ts`` of a capture) are kept."""
    lowered = F.lower(F.col("membership_tier"))
    tier = F.when(lowered.isin(*TIERS), lowered).otherwise(F.lit(DEFAULT_TIER))
    extra = [c for c in raw.columns if c not in
             ("user_id", "membership_tier", "region", "device_preference", "created_at", "_loaded_at")]
    return raw.select(*extra,
                      F.col("user_id").cast("string").alias("user_id"),
                      tier.alias("membership_tier"),
                      "region", "device_preference",
                      F.col("created_at").cast("date").alias("created_at"),
                      F.col("created_at").cast("date").alias("updated_at"))
