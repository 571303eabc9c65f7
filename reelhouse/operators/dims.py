"""Content (type 1) and calendar (type 0) dimensions."""

from __future__ import annotations

from datetime import date as _date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.calendar import day_of_week_as_coded, iso_day_of_week, week_of_year_monday
from reelhouse.functions.keys import surrogate_key

# Default calendar span.
CALENDAR_START = "1995-01-01"
CALENDAR_END = "2025-12-31"
GENRE_JOIN = ", "


def dim_content(stg_movies: DataFrame, updated_at=None) -> DataFrame:
    """C4: one row per title; full rebuild (type 1).  ``updated_at`` defaults to
    the current timestamp (pass a fixed value for reproducible output)."""
    stamp = F.current_timestamp() if updated_at is None else F.lit(updated_at).cast("timestamp")
    return stg_movies.select(
        surrogate_key("movie_id").alias("content_sk"),
        "movie_id",
        F.col("title_clean").alias("title"),
        "title_raw", "release_year", "era", "primary_genre",
        F.array_join("genres_array", GENRE_JOIN).alias("all_genres"),
        "genre_count",
        (F.col("genre_count") > 1).alias("is_multi_genre"),
        stamp.alias("updated_at"))


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day in [start, end] with calendar attributes.

    The day spine comes from ``spark.range`` over the day offsets, so it is
    generated in parallel across partitions instead of as one exploded array.
    ``day_of_week`` follows the reference's formula (Monday=7, Sunday=6);
    ``iso_day_of_week`` is Monday=1..Sunday=7."""
    n_days = (_date.fromisoformat(end) - _date.fromisoformat(start)).days
    d = F.col("full_date")
    q = ((F.month(d) - 1) / 3).cast("int") + 1
    y = F.year(d)
    return (spark.range(0, n_days + 1)
            .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date"))
            .select((y * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_sk"),
                    d,
                    y.alias("year"),
                    q.alias("quarter"),
                    F.concat(F.lit("Q"), q.cast("string")).alias("quarter_name"),
                    F.month(d).alias("month"),
                    F.date_format(d, "MMMM").alias("month_name"),
                    F.date_format(d, "MMM").alias("month_short"),
                    week_of_year_monday(d).alias("week_of_year"),
                    F.dayofmonth(d).alias("day_of_month"),
                    day_of_week_as_coded(d).alias("day_of_week"),
                    iso_day_of_week(d).alias("iso_day_of_week"),
                    F.date_format(d, "EEEE").alias("day_name"),
                    F.dayofweek(d).isin(1, 7).alias("is_weekend"),
                    (((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)).alias("is_leap_year"),
                    F.dayofmonth(F.last_day(d)).alias("days_in_month")))


def dim_date_covering(df: DataFrame, ts_col: str = "rated_at") -> DataFrame:
    """A calendar spanning whole years from the first to the last year of
    ``ts_col`` in ``df`` (one small aggregation to find the bounds)."""
    lo, hi = df.agg(F.min(F.year(ts_col)), F.max(F.year(ts_col))).first()
    if lo is None:
        return dim_date(df.sparkSession, CALENDAR_START, CALENDAR_START).limit(0)
    return dim_date(df.sparkSession, f"{lo:04d}-01-01", f"{hi:04d}-12-31")
