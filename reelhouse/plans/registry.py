"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir), reads the whole driver tables through the
lazy :class:`GoldBuild`, and returns a DataFrame.  Timestamps are returned as
UTC wall-clock TIMESTAMP_NTZ so results compare equal whatever the client's
time zone.  Thresholds scale to the fixture: 12-43 ratings per title at sf0.01.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.functions.keys import epoch_seconds, surrogate_key
from reelhouse.functions.scoring import bayesian_score, era_bucket
from reelhouse.operators import analytics, dims, facts, features, history, quality, tags
from reelhouse.operators import mart as mart_ops
from reelhouse.plans import oracle as O
from reelhouse.plans.gold import GoldBuild
from reelhouse.session import checkpoint_root
from reelhouse.sources import counts as counts_src
from reelhouse.sources import files, sinks, synth
from reelhouse.streaming import incremental, ratings_stream, scd2_stream

# Fixture-scaled thresholds of the analyst queries.
TOP_MIN_RATINGS = 20
CONTROVERSIAL_MIN_RATINGS = 10

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def wallclock(df: DataFrame) -> DataFrame:
    """TIMESTAMP (instant) columns -> TIMESTAMP_NTZ in the session zone (UTC)."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def register(name: str, sql: str | None):
    def deco(fn: Callable[[GoldBuild], DataFrame]):
        def builder(spark: SparkSession, sf_dir: str) -> DataFrame:
            return wallclock(fn(GoldBuild(spark, sf_dir)))
        builder.__name__ = name
        builder.__doc__ = fn.__doc__
        REGISTRY[name] = (builder, sql)
        return fn
    return deco


# --- silver -------------------------------------------------------------------
@register("stage_ratings", O.sql_with("SELECT * FROM stg_ratings", "stg_ratings"))
def _stage_ratings(g: GoldBuild) -> DataFrame:
    return g.stg_ratings


@register("stage_movies", O.sql_with("SELECT * FROM stg_movies", "stg_movies"))
def _stage_movies(g: GoldBuild) -> DataFrame:
    return g.stg_movies


@register("stage_users", O.sql_with("SELECT * FROM stg_user_captures", "stg_user_captures"))
def _stage_users(g: GoldBuild) -> DataFrame:
    return g.stg_user_captures


# --- history and dimensions ----------------------------------------------------
@register("scd2_from_captures", O.sql_with("SELECT * FROM user_snapshot", "user_snapshot"))
def _scd2_from_captures(g: GoldBuild) -> DataFrame:
    return g.user_snapshot


@register("dim_user", O.sql_with("SELECT * FROM dim_user", "dim_user"))
def _dim_user(g: GoldBuild) -> DataFrame:
    return g.dim_user


@register("dim_content", O.sql_with("SELECT * FROM dim_content", "dim_content"))
def _dim_content(g: GoldBuild) -> DataFrame:
    return g.dim_content.drop("updated_at")


# --- fact and mart ---------------------------------------------------------------
@register("fact_viewership", O.sql_with("SELECT * FROM fact", "fact"))
def _fact(g: GoldBuild) -> DataFrame:
    return g.fact


@register("global_prior", O.sql_with("SELECT prior_mean, prior_count FROM prior", "prior"))
def _global_prior(g: GoldBuild) -> DataFrame:
    return mart_ops.global_prior(g.histogram)


@register("title_stats", O.sql_with("SELECT * EXCLUDE (rating_sum) FROM per_title", "per_title"))
def _title_stats(g: GoldBuild) -> DataFrame:
    return mart_ops.title_stats(g.fact, g.dim_user, g.histogram).drop("rating_sum")


@register("mart_content_performance", O.sql_with("SELECT * FROM mart", "mart"))
def _mart(g: GoldBuild) -> DataFrame:
    return g.mart


# --- analyst queries ----------------------------------------------------------------
@register("top_titles", O.sql_with(f"""
SELECT title, primary_genre, era, avg_rating, total_ratings, weighted_score
FROM mart WHERE total_ratings >= {TOP_MIN_RATINGS}
ORDER BY weighted_score DESC NULLS LAST, total_ratings DESC, movie_id ASC
LIMIT 10""", "mart"))
def _top_titles(g: GoldBuild) -> DataFrame:
    return analytics.top_titles(g.mart, min_ratings=TOP_MIN_RATINGS)


@register("rating_trend_yoy", O.sql_with("""
SELECT rating_year, avg_rating, n, avg_rating - lag(avg_rating) OVER (ORDER BY rating_year) AS yoy_delta
FROM (SELECT rating_year, SUM(rating_value)::DOUBLE / COUNT(*) AS avg_rating, COUNT(*) AS n
      FROM fact GROUP BY rating_year) y
ORDER BY rating_year""", "fact"))
def _trend(g: GoldBuild) -> DataFrame:
    return analytics.rating_trend_yoy(g.fact)


@register("genre_popularity", O.sql_with("""
SELECT primary_genre, CAST(SUM(total_ratings) AS BIGINT) AS total_ratings,
       SUM(avg_rating)::DOUBLE / COUNT(avg_rating) AS avg_rating_across_titles,
       COUNT(*) AS title_count
FROM mart GROUP BY primary_genre ORDER BY total_ratings DESC""", "mart"))
def _genres(g: GoldBuild) -> DataFrame:
    return analytics.genre_popularity(g.mart)


@register("tier_behavior", O.sql_with("""
SELECT membership_tier_at_rating AS tier,
       SUM(rating_value)::DOUBLE / COUNT(*) AS avg_rating,
       COUNT(*) AS rating_count,
       (COUNT(*) FILTER (WHERE is_positive))::DOUBLE / COUNT(*) AS pct_positive
FROM fact GROUP BY membership_tier_at_rating ORDER BY rating_count DESC""", "fact"))
def _tiers(g: GoldBuild) -> DataFrame:
    return analytics.tier_behavior(g.fact)


@register("tier_behavior_from_histogram", REGISTRY["tier_behavior"][1])
def _tiers_hist(g: GoldBuild) -> DataFrame:
    """F4 answered from the (title, value) histogram; same result as the fact scan."""
    return analytics.tier_behavior_from_histogram(g.histogram)


@register("era_analysis", O.sql_with("""
SELECT era, SUM(avg_rating)::DOUBLE / COUNT(avg_rating) AS era_avg_rating,
       CAST(SUM(total_ratings) AS BIGINT) AS era_ratings, COUNT(*) AS title_count
FROM mart GROUP BY era ORDER BY era_ratings DESC""", "mart"))
def _eras(g: GoldBuild) -> DataFrame:
    return analytics.era_analysis(g.mart)


@register("user_cohorts", O.sql_with("""
SELECT CASE WHEN n_ratings < 10 THEN 'casual' WHEN n_ratings <= 50 THEN 'moderate' ELSE 'power' END AS cohort,
       COUNT(*) AS users, round(AVG(avg_rating), 6) AS avg_user_rating,
       SUM(n_ratings)::DOUBLE / COUNT(*) AS avg_n_ratings
FROM (SELECT user_sk, COUNT(*) AS n_ratings, SUM(rating_value)::DOUBLE / COUNT(*) AS avg_rating
      FROM fact GROUP BY user_sk) u
GROUP BY cohort ORDER BY cohort""", "fact"))
def _cohorts(g: GoldBuild) -> DataFrame:
    return analytics.user_cohorts(g.fact)


@register("controversial_titles", O.sql_with(f"""
SELECT title, primary_genre, total_ratings, avg_rating, rating_stddev
FROM mart WHERE rating_stddev > 1.5 AND total_ratings >= {CONTROVERSIAL_MIN_RATINGS}
ORDER BY rating_stddev DESC, total_ratings DESC, movie_id ASC
LIMIT 20""", "mart"))
def _controversial(g: GoldBuild) -> DataFrame:
    return analytics.controversial_titles(g.mart, min_ratings=CONTROVERSIAL_MIN_RATINGS)


@register("tier_change_history", O.sql_with("""
SELECT user_id, list(membership_tier ORDER BY valid_from) AS tier_history, COUNT(*) AS rows_in_dim_user
FROM dim_user GROUP BY user_id HAVING COUNT(*) > 1
ORDER BY rows_in_dim_user DESC, user_id ASC
LIMIT 20""", "dim_user"))
def _tier_changes(g: GoldBuild) -> DataFrame:
    # the query reads dim_user three times: cut its lineage once (shared checkpoint folder)
    checkpoint_root(g.spark)
    return analytics.tier_change_history(g.dim_user.checkpoint())


# --- more silver / keys ----------------------------------------------------------
@register("era_bucket", O.sql_with("""
SELECT DISTINCT release_year,
       CASE WHEN release_year < 1980 THEN 'classic' WHEN release_year < 2000 THEN 'modern'
            WHEN release_year < 2015 THEN 'contemporary' ELSE 'recent' END AS era
FROM stg_movies""", "stg_movies"))
def _era_bucket(g: GoldBuild) -> DataFrame:
    return g.stg_movies.select("release_year").distinct().select("release_year",
                                                                  era_bucket("release_year").alias("era"))


@register("stage_tags", O.sql_with("SELECT * FROM stg_tags", "stg_tags"))
def _stage_tags(g: GoldBuild) -> DataFrame:
    return g.stg_tags


@register("surrogate_key", O.sql_with(f"""
SELECT user_id, movie_id, CAST(epoch(rated_at) AS BIGINT) AS rated_epoch,
       {O.sk('user_id', 'movie_id', 'CAST(epoch(rated_at) AS BIGINT)')} AS rating_sk
FROM stg_ratings""", "stg_ratings"))
def _surrogate_key(g: GoldBuild) -> DataFrame:
    r = g.stg_ratings
    return r.select("user_id", "movie_id", epoch_seconds("rated_at").alias("rated_epoch"),
                    surrogate_key("user_id", "movie_id", epoch_seconds("rated_at")).alias("rating_sk"))


# --- history ------------------------------------------------------------------------
@register("scd2_capture", O.sql_with("SELECT * FROM user_snapshot", "user_snapshot"))
def _scd2_capture(g: GoldBuild) -> DataFrame:
    """C1 folded over the captures in time order (equals C2)."""
    checkpoint_root(g.spark)
    caps = g.stg_user_captures
    hist = None
    for d in g.capture_dates:
        ts = F.lit(d).cast("date").cast("timestamp")
        # each merged history is persisted before the next capture, as in a daily run
        hist = history.scd2_capture(hist, caps.filter(F.col("capture_ts") == ts), ts).checkpoint()
    return hist.select(*g.user_snapshot.columns)


@register("dim_user_as_of", O.sql_with("""
SELECT * FROM dim_user
WHERE valid_from <= TIMESTAMP '1999-01-01 00:00:00' AND TIMESTAMP '1999-01-01 00:00:00' < valid_to""",
                                      "dim_user"))
def _dim_user_as_of(g: GoldBuild) -> DataFrame:
    return history.dim_user_as_of(g.dim_user, "1999-01-01 00:00:00")


@register("dim_date", O.sql_with("SELECT * FROM dim_date_data", "dim_date_data"))
def _dim_date(g: GoldBuild) -> DataFrame:
    """C5 spanning the years of the staged ratings."""
    return dims.dim_date_covering(g.stg_ratings)


@register("version_overlap", O.sql_with("SELECT * FROM overlap_clean", "overlap_clean"))
def _overlap(g: GoldBuild) -> DataFrame:
    return history.version_overlaps(g.dim_user)


def dirty_versions(dim_user: DataFrame) -> DataFrame:
    """Dirty twin of dim_user: every closed version ends 400 days late."""
    return dim_user.withColumn("valid_to", F.when(F.col("is_current"), F.col("valid_to"))
                               .otherwise(F.col("valid_to") + F.expr("INTERVAL 400 DAYS")))


@register("version_overlap_dirty", O.sql_with("SELECT * FROM overlap_dirty", "overlap_dirty"))
def _overlap_dirty(g: GoldBuild) -> DataFrame:
    return history.version_overlaps(dirty_versions(g.dim_user))


# --- joins ----------------------------------------------------------------------------
@register("rating_as_of", O.sql_with("""
SELECT r.*, u.user_sk, u.membership_tier, u.region, u.device_preference, u.created_at,
       u.valid_from, u.valid_to, u.is_current
FROM stg_ratings r LEFT JOIN dim_user u
  ON u.user_id = r.user_id AND r.rated_at >= u.valid_from AND r.rated_at < u.valid_to""",
                                      "stg_ratings", "dim_user"))
def _rating_as_of(g: GoldBuild) -> DataFrame:
    return facts.rating_as_of(g.stg_ratings, g.dim_user, "user_id", "rated_at", how="left")


@register("fact_left_user", O.sql_with("""
SELECT content_sk, unique_raters, unique_regions FROM per_title""", "per_title"))
def _fact_left_user(g: GoldBuild) -> DataFrame:
    return mart_ops.title_audience(g.fact, g.dim_user)


@register("orphan_facts", O.sql_with("""
SELECT f.rating_sk, f.content_sk FROM fact f ANTI JOIN dim_content c ON c.content_sk = f.content_sk""",
                                      "fact", "dim_content"))
def _orphans(g: GoldBuild) -> DataFrame:
    return facts.orphan_facts(g.fact, g.dim_content)


@register("orphan_ratings_dirty", O.sql_with(f"""
SELECT rating_sk, content_sk FROM (
  SELECT {O.sk('user_id', 'movie_id', 'CAST(epoch(rated_at) AS BIGINT)')} AS rating_sk,
         {O.sk('movie_id')} AS content_sk FROM stg_ratings) r
WHERE content_sk NOT IN (SELECT content_sk FROM dim_content)""", "stg_ratings", "dim_content"))
def _orphans_dirty(g: GoldBuild) -> DataFrame:
    """D6 on a dirty twin: every staged rating keyed to its title, including
    titles the content dimension dropped."""
    r = g.stg_ratings.select(surrogate_key("user_id", "movie_id", epoch_seconds("rated_at")).alias("rating_sk"),
                             surrogate_key("movie_id").alias("content_sk"))
    return facts.orphan_facts(r, g.dim_content)


@register("latest_rating", O.sql_with("""
SELECT * EXCLUDE (rn) FROM (
  SELECT f.*, u.user_id,
         row_number() OVER (PARTITION BY u.user_id, f.content_sk
                            ORDER BY f.rated_at DESC, f.rating_sk DESC, f.rating_value DESC) AS rn
  FROM fact f JOIN dim_user u ON u.user_sk = f.user_sk) x WHERE rn = 1""", "fact", "dim_user"))
def _latest(g: GoldBuild) -> DataFrame:
    return facts.latest_rating(facts.attach_user_id(g.fact, g.dim_user))


# --- quality ----------------------------------------------------------------------------
@register("check_not_null_fact", O.sql_with("""
SELECT * FROM fact WHERE rating_sk IS NULL OR user_sk IS NULL OR content_sk IS NULL OR date_sk IS NULL
   OR rating_value IS NULL""", "fact"))
def _nn(g: GoldBuild) -> DataFrame:
    return quality.check_not_null(g.fact, "rating_sk", "user_sk", "content_sk", "date_sk", "rating_value")


@register("check_not_null_raw_dirty", O.sql_with(r"""
SELECT * FROM fx_movies WHERE regexp_extract(title, '\((\d{4})\)\s*$', 1) = ''""", "fx_movies"))
def _nn_dirty(g: GoldBuild) -> DataFrame:
    """G1 on a dirty twin: titles whose parsed year would be null."""
    parsed = g.raw_movies.withColumn("_y", F.regexp_extract("title", r"\((\d{4})\)\s*$", 1).try_cast("int"))
    return quality.check_not_null(parsed, "_y").drop("_y")


@register("check_unique_rating_sk", O.sql_with("""
SELECT rating_sk, COUNT(*) AS n FROM fact WHERE rating_sk IS NOT NULL GROUP BY rating_sk HAVING COUNT(*) > 1""",
                                             "fact"))
def _uniq(g: GoldBuild) -> DataFrame:
    return quality.check_unique(g.fact, "rating_sk")


@register("check_accepted_tiers_raw", O.sql_with("""
SELECT * FROM fx_user_captures
WHERE membership_tier IS NOT NULL AND membership_tier NOT IN ('basic', 'standard', 'premium')""",
                                               "fx_user_captures"))
def _accepted_raw(g: GoldBuild) -> DataFrame:
    return quality.check_accepted_values(g.raw_user_captures, "membership_tier", quality.TIERS)


@register("check_accepted_values_gold", O.sql_with("""
SELECT user_sk, membership_tier, region FROM dim_user
WHERE membership_tier NOT IN ('basic', 'standard', 'premium') OR region NOT IN ('NA', 'EU', 'APAC', 'LATAM')""",
                                                 "dim_user"))
def _accepted_gold(g: GoldBuild) -> DataFrame:
    d = g.dim_user.select("user_sk", "membership_tier", "region")
    return (quality.check_accepted_values(d, "membership_tier", quality.TIERS)
            .unionByName(quality.check_accepted_values(d, "region", quality.REGIONS)).distinct())


@register("check_relationships_fact_date", O.sql_with("""
SELECT f.* FROM fact f ANTI JOIN dim_date_default d ON d.date_sk = f.date_sk""", "fact", "dim_date_default"))
def _rel(g: GoldBuild) -> DataFrame:
    return quality.check_relationships(g.fact, "date_sk", g.dim_date)


@register("check_rating_range_raw", O.sql_with("""
SELECT "userId", "movieId", rating FROM fx_ratings WHERE NOT (rating BETWEEN 0.5 AND 5.0)""", "fx_ratings"))
def _range_raw(g: GoldBuild) -> DataFrame:
    return quality.check_rating_range(g.raw_ratings, "rating", keep=("userId", "movieId"))


@register("check_rating_range", O.sql_with("""
SELECT rating_sk, rating_value FROM fact WHERE NOT (rating_value BETWEEN 0.5 AND 5.0)""", "fact"))
def _range_fact(g: GoldBuild) -> DataFrame:
    return quality.check_rating_range(g.fact)


@register("check_scd2_no_overlap", O.sql_with("SELECT * FROM overlap_clean", "overlap_clean"))
def _no_overlap(g: GoldBuild) -> DataFrame:
    return quality.check_scd2_no_overlap(g.dim_user)


@register("check_no_orphans", O.sql_with("""
SELECT f.rating_sk, f.content_sk FROM fact f LEFT JOIN dim_content c USING (content_sk)
WHERE c.content_sk IS NULL""", "fact", "dim_content"))
def _no_orphans(g: GoldBuild) -> DataFrame:
    return quality.check_no_orphans(g.fact, g.dim_content)


def _verdict(df: DataFrame) -> DataFrame:
    return df.select("check", "column", "status")


@register("check_row_count", O.sql_with("""
SELECT 'RowCountCheck' AS "check", CAST(NULL AS VARCHAR) AS "column",
       CASE WHEN COUNT(*) BETWEEN 1000 AND 200000 THEN 'pass' ELSE 'fail' END AS status FROM mart""", "mart"))
def _rowcount(g: GoldBuild) -> DataFrame:
    return _verdict(quality.check_row_count(g.mart, 1_000, 200_000))


@register("check_row_count_fact", O.sql_with("""
SELECT 'RowCountCheck' AS "check", CAST(NULL AS VARCHAR) AS "column",
       CASE WHEN COUNT(*) BETWEEN 10000000 AND 30000000 THEN 'pass' ELSE 'fail' END AS status FROM fact""",
                                           "fact"))
def _rowcount_fact(g: GoldBuild) -> DataFrame:
    """The reference's bounds for 25M ratings: fails on the fixture, as it should."""
    return _verdict(quality.check_row_count(g.fact, 10_000_000, 30_000_000))


@register("check_null_rate", O.sql_with("""
SELECT 'NullRateCheck' AS "check", 'rating_stddev' AS "column",
       CASE WHEN (COUNT(*) FILTER (WHERE rating_stddev IS NULL))::DOUBLE / COUNT(*) <= 0.0 THEN 'pass' ELSE 'fail' END
       AS status FROM mart""", "mart"))
def _nullrate(g: GoldBuild) -> DataFrame:
    return _verdict(quality.check_null_rate(g.mart, "rating_stddev", 0.0))


@register("check_range", O.sql_with("""
SELECT 'RangeCheck' AS "check", 'pct_positive' AS "column",
       CASE WHEN min(pct_positive) >= 0 AND max(pct_positive) <= 100 THEN 'pass' ELSE 'fail' END AS status
FROM mart""", "mart"))
def _range(g: GoldBuild) -> DataFrame:
    return _verdict(quality.check_range(g.mart, "pct_positive", 0.0, 100.0))


@register("check_uniqueness", O.sql_with("""
SELECT 'UniquenessCheck' AS "check", 'rating_sk' AS "column",
       CASE WHEN 1.0 - COUNT(DISTINCT rating_sk)::DOUBLE / COUNT(rating_sk) <= 0.0 THEN 'pass' ELSE 'fail' END
       AS status FROM fact""", "fact"))
def _uniqueness(g: GoldBuild) -> DataFrame:
    return _verdict(quality.check_uniqueness(g.fact, "rating_sk", 0.0))


@register("check_distribution", O.sql_with("""
SELECT 'DistributionCheck' AS "check", 'avg_rating' AS "column",
       CASE WHEN abs(avg(CAST(avg_rating AS DOUBLE)) - 3.5) / stddev_samp(CAST(avg_rating AS DOUBLE)) <= 4.0
            THEN 'pass' ELSE 'fail' END AS status FROM mart""", "mart"))
def _distribution(g: GoldBuild) -> DataFrame:
    return _verdict(quality.check_distribution(g.mart, "avg_rating", 3.5, 4.0))


_MART_CHECK_ROWS = """
  ('RowCountCheck', NULL, (SELECT CASE WHEN COUNT(*) BETWEEN 1000 AND 200000 THEN 'pass' ELSE 'fail' END FROM mart)),
  ('NullRateCheck', 'content_sk', (SELECT CASE WHEN COUNT(*) FILTER (WHERE content_sk IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM mart)),
  ('NullRateCheck', 'avg_rating', (SELECT CASE WHEN COUNT(*) FILTER (WHERE avg_rating IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM mart)),
  ('NullRateCheck', 'primary_genre', (SELECT CASE WHEN COUNT(*) FILTER (WHERE primary_genre IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM mart)),
  ('RangeCheck', 'avg_rating', (SELECT CASE WHEN min(avg_rating) >= 0.5 AND max(avg_rating) <= 5.0 THEN 'pass' ELSE 'fail' END FROM mart)),
  ('RangeCheck', 'pct_positive', (SELECT CASE WHEN min(pct_positive) >= 0 AND max(pct_positive) <= 100 THEN 'pass' ELSE 'fail' END FROM mart)),
  ('RangeCheck', 'release_year', (SELECT CASE WHEN min(release_year) >= 1888 AND max(release_year) <= 2026 THEN 'pass' ELSE 'fail' END FROM mart)),
  ('UniquenessCheck', 'content_sk', (SELECT CASE WHEN COUNT(DISTINCT content_sk) = COUNT(content_sk) THEN 'pass' ELSE 'fail' END FROM mart)),
  ('UniquenessCheck', 'movie_id', (SELECT CASE WHEN COUNT(DISTINCT movie_id) = COUNT(movie_id) THEN 'pass' ELSE 'fail' END FROM mart)),
  ('DistributionCheck', 'avg_rating', (SELECT CASE WHEN abs(avg(CAST(avg_rating AS DOUBLE)) - 3.5)
        / stddev_samp(CAST(avg_rating AS DOUBLE)) <= 4.0 THEN 'pass' ELSE 'fail' END FROM mart))"""


def report_sql(rows: str) -> str:
    """Check rows plus an overall row that fails when any check does."""
    checks = f'(SELECT * FROM (VALUES {rows}) t("check", "column", status))'
    return (f"SELECT * FROM {checks} c UNION ALL SELECT 'overall', NULL, "
            f"CASE WHEN bool_and(status = 'pass') THEN 'pass' ELSE 'fail' END FROM {checks} c2")


@register("quality_report", O.sql_with(report_sql(_MART_CHECK_ROWS), "mart"))
def _report(g: GoldBuild) -> DataFrame:
    """G14 with the reference's mart suite minus the schema check (metadata
    only; covered by tests)."""
    checks = [c for c in quality.gold_mart_checks() if not isinstance(c, quality.SchemaCheck)]
    return _verdict(quality.quality_report(g.mart, checks))


# --- features and tags ---------------------------------------------------------------------
@register("content_features", O.sql_with("""
SELECT c.content_sk, m.movie_id, m.release_year, m.era, m.genre_count,
       CAST(generate_subscripts(m.genres_array, 1) - 1 AS INTEGER) AS genre_pos, unnest(m.genres_array) AS genre
FROM stg_movies m JOIN dim_content c ON c.movie_id = m.movie_id""", "stg_movies", "dim_content"))
def _content_features(g: GoldBuild) -> DataFrame:
    return features.content_features(g.stg_movies)


@register("user_item_ratings", O.sql_with("""
SELECT CAST(u.user_id AS BIGINT) AS user_id, CAST(c.movie_id AS BIGINT) AS movie_id,
       CAST(f.rating_value AS DOUBLE) AS rating, f.rated_at
FROM fact f JOIN dim_user u ON u.user_sk = f.user_sk JOIN dim_content c ON c.content_sk = f.content_sk""",
                                           "fact", "dim_user", "dim_content"))
def _user_item(g: GoldBuild) -> DataFrame:
    return features.user_item_ratings(g.fact, g.dim_user, g.dim_content)


@register("engagement_features", O.sql_with("""
SELECT content_sk, movie_id, total_ratings, avg_rating, pct_positive, unique_raters, weighted_score FROM mart""",
                                             "mart"))
def _engagement(g: GoldBuild) -> DataFrame:
    return features.engagement_features(g.mart)


@register("recency_features", O.sql_with("""
SELECT rating_sk, user_sk, content_sk, rated_at, days_since_release FROM fact""", "fact"))
def _recency(g: GoldBuild) -> DataFrame:
    return features.recency_features(g.fact)


@register("dim_tag", O.sql_with(f"""
SELECT {O.sk('tag_normalized')} AS tag_sk, tag_normalized, COUNT(*) AS n_uses,
       COUNT(DISTINCT movie_id) AS n_titles, COUNT(DISTINCT user_id) AS n_users,
       min(tagged_at) AS first_tagged_at, max(tagged_at) AS last_tagged_at
FROM stg_tags GROUP BY tag_normalized""", "stg_tags"))
def _dim_tag(g: GoldBuild) -> DataFrame:
    return tags.dim_tag(g.stg_tags)


@register("bridge_content_tag", O.sql_with(f"""
SELECT c.content_sk, {O.sk('t.tag_normalized')} AS tag_sk, t.tag_normalized, t.n_users, t.last_tagged_at
FROM (SELECT movie_id, tag_normalized, COUNT(*) AS n_users, max(tagged_at) AS last_tagged_at
      FROM stg_tags GROUP BY movie_id, tag_normalized) t
JOIN dim_content c ON c.movie_id = t.movie_id""", "stg_tags", "dim_content"))
def _bridge(g: GoldBuild) -> DataFrame:
    return tags.bridge_content_tag(g.stg_tags, g.dim_content)


# --- sources and sinks (files staged by Spark from the driver tables) ----------------------
def staging_dir(g: GoldBuild, name: str) -> str:
    """A fresh folder under the shared checkpoint root for files a query stages."""
    return f"{checkpoint_root(g.spark)}/reelhouse-staging/{name}-{uuid.uuid4().hex}"


def staged_csv(g: GoldBuild, name: str, df: DataFrame) -> str:
    return files.write_csv(df, staging_dir(g, name))


@register("scan_ratings", O.sql_with("SELECT * FROM fx_ratings", "fx_ratings"))
def _scan_ratings(g: GoldBuild) -> DataFrame:
    """A1: the ratings written as CSV by Spark, scanned back with the declared schema."""
    return files.scan_ratings(g.spark, staged_csv(g, "ratings", g.raw_ratings))


@register("scan_movies", O.sql_with("SELECT * FROM fx_movies", "fx_movies"))
def _scan_movies(g: GoldBuild) -> DataFrame:
    return files.scan_movies(g.spark, staged_csv(g, "movies", g.raw_movies))


@register("scan_tags", O.sql_with("""
SELECT "userId", "movieId", nullif(tag, '') AS tag, "timestamp" FROM fx_tags""", "fx_tags"))
def _scan_tags(g: GoldBuild) -> DataFrame:
    """A3: an empty tag comes back as NULL - CSV has one empty field for both,
    and the silver filter drops either."""
    return files.scan_tags(g.spark, staged_csv(g, "tags", g.raw_tags))


@register("scan_users", O.sql_with("""
SELECT user_id, membership_tier, region, device_preference, created_at FROM fx_user_captures""", "fx_user_captures"))
def _scan_users(g: GoldBuild) -> DataFrame:
    """A4: all user captures as users.csv (region NA must stay text)."""
    return files.scan_users(g.spark, staged_csv(g, "users", g.raw_user_captures.drop("capture_ts")))


@register("scan_rejected", O.sql_with("""
SELECT 'accepted' AS outcome, count(*) AS n FROM fx_ratings WHERE "movieId" % 7 <> 0
UNION ALL SELECT 'rejected', count(*) FROM fx_ratings WHERE "movieId" % 7 = 0""", "fx_ratings"))
def _scan_rejected(g: GoldBuild) -> DataFrame:
    """A1 on a dirty twin: titles divisible by seven are written with a letter in their id.  These
    lines are returned as rejected, none becomes a row of nulls."""
    dirty = g.raw_ratings.withColumn("movieId", F.when(F.col("movieId") % 7 == 0, F.concat(F.lit("x"), "movieId"))
                                     .otherwise(F.col("movieId").cast("string")))
    path = staged_csv(g, "dirty-ratings", dirty)
    good = files.scan_ratings(g.spark, path).select(F.lit("accepted").alias("outcome"))
    bad = files.rejected(g.spark, path, files.RATINGS_SCHEMA).select(F.lit("rejected").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register("load_stamp", O.sql_with("""
SELECT *, TIMESTAMP '2026-01-01 00:00:00' AS _loaded_at FROM fx_movies""", "fx_movies"))
def _load_stamp(g: GoldBuild) -> DataFrame:
    return files.load_stamp(g.raw_movies, "2026-01-01 00:00:00")


@register("source_row_counts", O.sql_with("""
SELECT 'ratings' AS source, COUNT(*) AS n FROM fx_ratings
UNION ALL SELECT 'movies', COUNT(*) FROM fx_movies
UNION ALL SELECT 'tags', COUNT(*) FROM fx_tags
UNION ALL SELECT 'users', COUNT(*) FROM fx_user_captures
UNION ALL SELECT 'missing', 0""", "fx_ratings", "fx_movies", "fx_tags", "fx_user_captures"))
def _source_counts(g: GoldBuild) -> DataFrame:
    """A8 over staged CSV sources; the missing one counts 0."""
    root = staging_dir(g, "sources")
    files.write_csv(g.raw_ratings, root + "/ratings")
    files.write_csv(g.raw_movies, root + "/movies")
    files.write_csv(g.raw_tags, root + "/tags")
    files.write_csv(g.raw_user_captures.drop("capture_ts"), root + "/users")
    return counts_src.source_row_counts(g.spark, {
        "ratings": (files.scan_ratings, root + "/ratings"), "movies": (files.scan_movies, root + "/movies"),
        "tags": (files.scan_tags, root + "/tags"), "users": (files.scan_users, root + "/users"),
        "missing": (files.scan_users, root + "/no-such-file")})


@register("write_gold", O.sql_with("SELECT * FROM fact", "fact"))
def _write_gold(g: GoldBuild) -> DataFrame:
    """The fact written partitioned by year and read back."""
    path = sinks.write_gold(g.fact, staging_dir(g, "fact"), "rating_year")
    return g.spark.read.parquet(path).select(*g.fact.columns)


@register("read_gold_pruned", O.sql_with("SELECT * FROM fact WHERE rating_year IN (1996, 1997)", "fact"))
def _read_pruned(g: GoldBuild) -> DataFrame:
    """Only the 1996 and 1997 partitions are read (PartitionFilters)."""
    path = sinks.write_gold(g.fact, staging_dir(g, "fact"), "rating_year")
    return sinks.read_gold_pruned(g.spark, path, [1996, 1997]).select(*g.fact.columns)


_AUDIT_TS = "2026-01-02 03:04:05"


@register("append_run_audit", O.sql_with(f"""
SELECT 'run-1' AS run_id, TIMESTAMP '{_AUDIT_TS}' AS execution_date, q.status,
       (SELECT count(*) FROM fx_ratings) AS seed_ratings_rows, (SELECT count(*) FROM fx_movies) AS seed_movies_rows,
       (SELECT count(*) FROM fx_tags) AS seed_tags_rows, (SELECT count(*) FROM fx_user_captures) AS seed_users_rows,
       (SELECT count(*) FROM mart) AS gold_mart_rows, q.status AS observe_status
FROM (SELECT status FROM ({report_sql(_MART_CHECK_ROWS)}) r WHERE "check" = 'overall') q
UNION ALL SELECT 'run-2', TIMESTAMP '{_AUDIT_TS}', 'unknown', 0, 0, 0, 0, 0, 'unknown'""",
                                       "fx_ratings", "fx_movies", "fx_tags", "fx_user_captures", "mart"))
def _audit(g: GoldBuild) -> DataFrame:
    """A run with all its counts and one whose steps failed, appended to an audit table."""
    path = staging_dir(g, "audit")
    report = quality.quality_report(g.mart, quality.gold_mart_checks())
    counted = counts_src.source_row_counts(g.spark, {
        name: (lambda _, df: df, df) for name, df in
        (("ratings", g.raw_ratings), ("movies", g.raw_movies), ("tags", g.raw_tags), ("users", g.raw_user_captures))})
    sinks.append_run_audit(g.spark, path, "run-1", counted, report, _AUDIT_TS)
    return sinks.append_run_audit(g.spark, path, "run-2", None, None, _AUDIT_TS)


_MART_TYPES = {"content_sk": "string", "movie_id": "string", "release_year": "int", "total_ratings": "bigint",
               "avg_rating": "decimal(4,2)", "weighted_score": "double"}


_MART_TYPE_ROWS = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS expected_type, '{actual}' AS actual_type, '{status}' AS status,
       count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM mart"""
    for c, t, actual, status in (
        ("content_sk", "string", "string", "pass"), ("movie_id", "string", "string", "pass"),
        ("release_year", "int", "int", "pass"), ("total_ratings", "bigint", "bigint", "pass"),
        ("avg_rating", "decimal(4,2)", "decimal(4,2)", "pass"), ("weighted_score", "double", "decimal(6,4)", "fail")))


@register("check_schema", O.sql_with(_MART_TYPE_ROWS, "mart"))
def _schema(g: GoldBuild) -> DataFrame:
    """G10 on the mart, with one expectation that does not hold."""
    return quality.check_schema(g.mart, _MART_TYPES)


@register("bayesian_score", O.sql_with("""
SELECT content_sk, round((p.prior_count * p.prior_mean + t.rating_sum) / (p.prior_count + t.total_ratings), 9) AS score
FROM per_title t, prior p""", "per_title", "prior"))
def _bayes(g: GoldBuild) -> DataFrame:
    """E4 for every title."""
    rows = mart_ops.with_prior(mart_ops.title_rating_stats(g.histogram), mart_ops.global_prior(g.histogram))
    score = bayesian_score(F.col("total_ratings"), F.col("rating_sum"), F.col("prior_count"), F.col("prior_mean"))
    return rows.select("content_sk", F.round(score, 9).alias("score"))


@register("mart_cross_prior", O.sql_with("""
SELECT content_sk, total_ratings, round(prior_mean, 9) AS prior_mean, round(prior_count, 9) AS prior_count
FROM per_title, prior""", "per_title", "prior"))
def _cross_prior(g: GoldBuild) -> DataFrame:
    """The one-row prior beside every title."""
    rows = mart_ops.with_prior(mart_ops.title_rating_stats(g.histogram), mart_ops.global_prior(g.histogram))
    return rows.select("content_sk", "total_ratings", F.round("prior_mean", 9).alias("prior_mean"),
                       F.round("prior_count", 9).alias("prior_count"))


@register("global_prior_title", O.sql_with("""
SELECT round(avg(m), 9) AS prior_mean, round(sum(n)::DOUBLE / count(*), 9) AS prior_count
FROM (SELECT content_sk, sum(rating_value)::DOUBLE / count(*) AS m, count(*) AS n FROM fact GROUP BY content_sk) t""",
                                         "fact"))
def _prior_title(g: GoldBuild) -> DataFrame:
    """E1 over titles instead of (title, value) groups."""
    row = mart_ops.global_prior(g.histogram, "title")
    return row.select(F.round("prior_mean", 9).alias("prior_mean"), F.round("prior_count", 9).alias("prior_count"))


# --- streaming -------------------------------------------------------------------------------
@register("stream_ratings", O.sql_with("SELECT * FROM stg_ratings", "stg_ratings"))
def _stream_ratings(g: GoldBuild) -> DataFrame:
    """Lineitem files streamed (stream-static join to orders), staged by B1, compared with
    the months they touch in the sink; equals the batch silver ratings (the fixture has no replays)."""
    root = staging_dir(g, "stream-ratings")
    orders = g.spark.read.parquet(f"{g.sf_dir}/orders.parquet")
    raw = ratings_stream.lineitem_ratings_stream(g.spark, g.sf_dir, orders)
    return ratings_stream.run_silver_ratings(raw, root + "/out", root + "/ckpt")


@register("stream_ratings_late", O.sql_with("SELECT * FROM stg_ratings", "stg_ratings"))
def _stream_late(g: GoldBuild) -> DataFrame:
    """I1 with a hashed tenth of all ratings delivered last and then delivered again.  A delivery has as many files as
    it has tasks; the stream is run after each, so a delivery is a micro-batch."""
    root = staging_dir(g, "stream-late")
    late = F.pmod(F.xxhash64("userId", "movieId", "timestamp"), F.lit(10)) == 0
    for i, part in enumerate((g.raw_ratings.filter(~late), g.raw_ratings.filter(late), g.raw_ratings.filter(late))):
        part.write.parquet(f"{root}/in/delivery={i}")
        stream = (g.spark.readStream.schema(g.raw_ratings.schema).option("recursiveFileLookup", "true").parquet(root + "/in"))
        silver = ratings_stream.run_silver_ratings(stream, root + "/out", root + "/ckpt")
    return silver


def staged_tables(g: GoldBuild, name: str, *tables: DataFrame) -> list[DataFrame]:
    """Tables written once for the steps of a query that read them again."""
    return [g.spark.read.schema(t.schema).parquet(sinks.write_gold(t, staging_dir(g, f"{name}-table"))) for t in tables]


def _incremental_from(g: GoldBuild, name: str, first) -> DataFrame:
    """A fact of the ratings where ``first`` holds, then the whole source twice."""
    path = staging_dir(g, name)
    ratings, content, users = staged_tables(g, name, g.stg_ratings, g.dim_content, g.dim_user)
    sinks.write_gold(facts.fact_viewership(ratings.filter(first), content, users), path, "rating_year")
    for _ in range(2):
        incremental.incremental_fact(g.spark, path, ratings, content, users)
    return g.spark.read.parquet(path).select(*g.fact.columns)


@register("incremental_fact", O.sql_with("SELECT * FROM fact", "fact"))
def _incremental(g: GoldBuild) -> DataFrame:
    """Facts before 1999, then the rest; the table ends equal to the full fact, and a second
    run adds nothing."""
    return _incremental_from(g, "incremental", F.col("rated_at") < F.lit("1999-01-01").cast("timestamp"))


@register("incremental_fact_late", O.sql_with("SELECT * FROM fact", "fact"))
def _incremental_late(g: GoldBuild) -> DataFrame:
    """I2 with a hashed tenth of the ratings of all years arriving late."""
    return _incremental_from(g, "incremental-late", F.pmod(F.xxhash64("user_id", "movie_id", "rated_at"), F.lit(10)) != 0)


def _captures_stream(g: GoldBuild, name: str, files_per_capture: int) -> DataFrame:
    root = staging_dir(g, name)
    caps = g.stg_user_captures
    part = F.pmod(F.xxhash64("user_id"), F.lit(files_per_capture))
    # file names sort by part first, so the captures arrive in turns, newest parts between older ones
    (caps.withColumn("part", part).repartition("part", "capture_ts").write.partitionBy("part", "capture_ts")
     .parquet(root + "/captures"))
    stream = (g.spark.readStream.schema(g.spark.read.parquet(root + "/captures").schema)
              .option("maxFilesPerTrigger", "1").parquet(root + "/captures")).drop("part")
    return scd2_stream.run_scd2_stream(stream, root + "/target", root + "/ckpt").select(*g.user_snapshot.columns)


@register("stream_scd2", O.sql_with("SELECT * FROM user_snapshot", "user_snapshot"))
def _stream_scd2(g: GoldBuild) -> DataFrame:
    """Captures arrive one file per capture."""
    return _captures_stream(g, "stream-scd2", 1)


@register("stream_scd2_split", O.sql_with("SELECT * FROM user_snapshot", "user_snapshot"))
def _stream_scd2_split(g: GoldBuild) -> DataFrame:
    """Each capture arrives in three files, one file per micro-batch, captures mixed."""
    return _captures_stream(g, "stream-scd2-split", 3)


@register("multi_partition_write", O.sql_with("SELECT * FROM fact", "fact"))
def _multi_partition(g: GoldBuild) -> DataFrame:
    """I4: the fact partitioned by year and month, read back."""
    path = incremental.multi_partition_write(g.fact, staging_dir(g, "fact-ym"))
    return g.spark.read.parquet(path).select(*g.fact.columns)


@register("synthesize_users", O.sql_with("""
SELECT CAST(c_custkey AS INTEGER) AS user_id,
       CASE WHEN t < 1288490188 THEN 'basic' WHEN t < 3006477107 THEN 'standard' ELSE 'premium' END
         AS membership_tier,
       CASE WHEN r < 1717986918 THEN 'NA' WHEN r < 3006477107 THEN 'EU' WHEN r < 3865470566 THEN 'APAC'
            ELSE 'LATAM' END AS region,
       ['desktop', 'mobile', 'tablet', 'tv'][CAST(d % 4 AS INTEGER) + 1] AS device_preference,
       CAST(DATE '2015-01-01' + CAST(c % 3653 AS INTEGER) AS DATE) AS created_at
FROM (SELECT c_custkey,
             CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '-42-tier'), 1, 8)) AS BIGINT) AS t,
             CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '-42-region'), 1, 8)) AS BIGINT) AS r,
             CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '-42-device'), 1, 8)) AS BIGINT) AS d,
             CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '-42-created'), 1, 8)) AS BIGINT) AS c
      FROM customer) h"""))
def _synth(g: GoldBuild) -> DataFrame:
    """A10: synthetic attributes for every customer key (seed 42)."""
    return synth.users_for_ids(g.spark.read.parquet(f"{g.sf_dir}/customer.parquet").select("c_custkey"),
                               "c_custkey", 42)


@register("daily_pipeline", O.sql_with("SELECT * FROM mart", "mart"))
def _daily(g: GoldBuild) -> DataFrame:
    """L2 on delivered files: the users file changes twice before the run, so the mart is right only
    if the stored history was kept; returns the mart of the published run."""
    from reelhouse.plans import pipeline
    root, out = staging_dir(g, "deliveries"), staging_dir(g, "daily")
    for name, df in (("ratings", g.raw_ratings), ("movies", g.raw_movies), ("tags", g.raw_tags)):
        files.write_csv(df, f"{root}/{name}")
    for day in g.capture_dates:
        users = g.raw_user_captures.filter(F.col("capture_ts") == F.lit(day).cast("timestamp")).drop("capture_ts")
        files.write_csv(users, f"{root}/users-{day}")
    *earlier, last = g.capture_dates
    for day in earlier:
        pipeline.update_user_history(g.spark, out, f"{root}/users-{day}", day)
    src = pipeline.SourceFiles(*(f"{root}/{n}" for n in ("ratings", "movies", "tags", f"users-{last}")), last)
    pipeline.run_pipeline(g.spark, src, out, run_id="registry-run")
    return pipeline.current_gold(g.spark, out).read(g.spark, "mart_content_performance")


_CONTRACT_TABLES = {"dim_content": "dim_content", "dim_user": "dim_user", "dim_date": "dim_date_default",
                    "fact_viewership": "fact", "mart_content_performance": "mart"}


@register("contract_violations", O.sql_with(O.contracts_sql(_CONTRACT_TABLES),
                                            *_CONTRACT_TABLES.values()))
def _contracts(g: GoldBuild) -> DataFrame:
    """Column contracts of all gold tables: one aggregation per table plus a
    grouping per unique test and an anti join per relationship."""
    return quality.contract_violations({"dim_content": g.dim_content, "dim_user": g.dim_user,
                                        "dim_date": g.dim_date, "fact_viewership": g.fact,
                                        "mart_content_performance": g.mart})


_FACT_CHECK_ROWS = """
  ('RowCountCheck', NULL, (SELECT CASE WHEN COUNT(*) BETWEEN 10000000 AND 30000000 THEN 'pass' ELSE 'fail' END FROM fact)),
  ('NullRateCheck', 'rating_sk', (SELECT CASE WHEN COUNT(*) FILTER (WHERE rating_sk IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM fact)),
  ('NullRateCheck', 'user_sk', (SELECT CASE WHEN COUNT(*) FILTER (WHERE user_sk IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM fact)),
  ('NullRateCheck', 'content_sk', (SELECT CASE WHEN COUNT(*) FILTER (WHERE content_sk IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM fact)),
  ('RangeCheck', 'rating_value', (SELECT CASE WHEN min(rating_value) >= 0.5 AND max(rating_value) <= 5.0 THEN 'pass' ELSE 'fail' END FROM fact)),
  ('UniquenessCheck', 'rating_sk', (SELECT CASE WHEN COUNT(DISTINCT rating_sk) = COUNT(rating_sk) THEN 'pass' ELSE 'fail' END FROM fact))"""


@register("quality_report_fact", O.sql_with(report_sql(_FACT_CHECK_ROWS), "fact"))
def _report_fact(g: GoldBuild) -> DataFrame:
    """G14 with the fact suite (defined, never run, in the reference): the
    25M-row bounds and the rating_sk collision make it fail on the fixture."""
    return _verdict(quality.quality_report(g.fact, quality.fact_checks()))


# --- the analyst queries through Spark SQL over gold views ---------------------------------
_SQL_PARAMS = {"top_titles": {"min_ratings": TOP_MIN_RATINGS},
               "controversial_titles": {"min_ratings": CONTROVERSIAL_MIN_RATINGS}}


def _sql_builder(name: str):
    def fn(g: GoldBuild) -> DataFrame:
        from reelhouse.plans.analyst_sql import analyst_sql, register_gold_views
        register_gold_views({"fact_viewership": g.fact, "mart_content_performance": g.mart,
                             "dim_user": g.dim_user})
        return analyst_sql(g.spark, name, **_SQL_PARAMS.get(name, {}))
    fn.__doc__ = f"F-query {name} as Spark SQL over gold views (same result as the DataFrame form)."
    return fn


for _name in ("top_titles", "rating_trend_yoy", "genre_popularity", "tier_behavior", "era_analysis",
              "user_cohorts", "controversial_titles", "tier_change_history"):
    register(f"sql_{_name}", REGISTRY[_name][1])(_sql_builder(_name))


# more queries register themselves with the names above
from reelhouse.plans import registry_windows  # noqa: E402,F401


def queries() -> dict[str, Builder]:
    return {name: b for name, (b, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
