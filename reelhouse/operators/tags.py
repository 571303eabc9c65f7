"""Tag dimension and title-tag bridge (I5) over the staged tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.keys import surrogate_key


def dim_tag(stg_tags: DataFrame) -> DataFrame:
    """One row per normalized tag: key, uses, distinct titles and users, first/last use."""
    return (stg_tags.groupBy("tag_normalized")
            .agg(F.count(F.lit(1)).alias("n_uses"),
                 F.count_distinct("movie_id").alias("n_titles"),
                 F.count_distinct("user_id").alias("n_users"),
                 F.min("tagged_at").alias("first_tagged_at"),
                 F.max("tagged_at").alias("last_tagged_at"))
            .select(surrogate_key("tag_normalized").alias("tag_sk"), "tag_normalized",
                    "n_uses", "n_titles", "n_users", "first_tagged_at", "last_tagged_at"))


def bridge_content_tag(stg_tags: DataFrame, dim_content: DataFrame) -> DataFrame:
    """(content_sk, tag_sk) with the number of users that gave the tag and the
    last time; tags of titles missing from the content dimension drop out."""
    content = dim_content.select("content_sk", "movie_id")
    return (stg_tags.groupBy("movie_id", "tag_normalized")
            .agg(F.count(F.lit(1)).alias("n_users"), F.max("tagged_at").alias("last_tagged_at"))
            .join(content, "movie_id")
            .select("content_sk", surrogate_key("tag_normalized").alias("tag_sk"),
                    "tag_normalized", "n_users", "last_tagged_at"))
