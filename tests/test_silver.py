from decimal import Decimal

from pyspark.sql import functions as F

from reelhouse.functions.scoring import era_bucket
from reelhouse.operators import silver


def test_stage_ratings_edges(spark):
    raw = spark.createDataFrame(
        [(1, 10, 0.49, 100), (1, 11, 0.5, 100), (1, 12, 3.45, 100), (1, 13, 3.5, 100),
         (1, 14, 5.0, 100), (1, 15, 5.01, 100), (1, 16, None, 100), (1, 17, 4.0, None)],
        "userId long, movieId long, rating double, timestamp long")
    out = {r.movie_id: r for r in silver.stage_ratings(raw).collect()}
    assert sorted(out) == ["11", "12", "13", "14"]
    assert out["12"].rating_value == Decimal("3.5") and out["12"].is_positive
    assert out["11"].is_positive is False
    assert out["14"].rating_value == Decimal("5.0")
    schema = dict((f.name, f.dataType.simpleString()) for f in silver.stage_ratings(raw).schema.fields)
    assert schema == {"user_id": "string", "movie_id": "string", "rating_value": "decimal(3,1)",
                      "rated_at": "timestamp", "is_positive": "boolean"}


def test_stage_movies_edges(spark):
    raw = spark.createDataFrame(
        [(1, "A (1999)", ""), (2, "B (1999) ", None), (3, "C", "X"), (4, "D (1887)", "X"),
         (5, "E (1888)", "Drama"), (6, "F (2027)", "X"), (7, "G (1999) extra", "X"),
         (8, "(2001) H (1980)", "Action|Comedy")],
        "movieId long, title string, genres string")
    out = {r.movie_id: r for r in silver.stage_movies(raw, current_year=2026).collect()}
    assert sorted(out) == ["1", "2", "5", "8"]
    assert out["8"].release_year == 1980 and out["8"].title_clean == "(2001) H"
    assert out["8"].genres_array == ["Action", "Comedy"] and out["8"].primary_genre == "Action"
    assert out["8"].genre_count == 2 and out["8"].era == "modern"
    assert out["2"].title_clean == "B" and out["2"].genres_array is None and out["2"].primary_genre is None
    assert out["5"].era == "classic" and out["5"].genre_count == 1


def test_era_bucket(spark):
    df = spark.createDataFrame([(y,) for y in (1979, 1980, 1999, 2000, 2014, 2015)], "y int")
    got = [r.e for r in df.select(era_bucket("y").alias("e")).collect()]
    assert got == ["classic", "modern", "modern", "contemporary", "contemporary", "recent"]


def test_stage_tags_edges(spark):
    raw = spark.createDataFrame(
        [(1, 2, "Fun", 10), (1, 2, " fun ", 30), (1, 2, "FUN", 20), (1, 2, "   ", 40),
         (1, 2, None, 50), (1, 2, "\t", 60)],
        "userId long, movieId long, tag string, timestamp long")
    out = silver.stage_tags(raw).collect()
    by_tag = {r.tag_normalized: r for r in out}
    assert set(by_tag) == {"fun", "\t"}
    assert by_tag["fun"].tagged_at == spark.range(1).select(F.timestamp_seconds(F.lit(30))).first()[0]


def test_stage_users_edges(spark):
    raw = spark.createDataFrame(
        [(1, "PREMIUM", "NA", "tv", "2020-01-02"), (2, " basic", "EU", "tv", "2020-01-02"),
         (3, None, "APAC", "tv", "2020-01-02"), (4, "gold", "LATAM", "tv", None)],
        "user_id int, membership_tier string, region string, device_preference string, created_at string")
    out = {r.user_id: r for r in silver.stage_users(raw).collect()}
    assert [out[k].membership_tier for k in "1234"] == ["premium", "standard", "standard", "standard"]
    assert out["1"].region == "NA" and str(out["1"].updated_at) == "2020-01-02"
    assert out["4"].created_at is None
