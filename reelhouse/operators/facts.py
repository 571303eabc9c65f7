"""Star-schema fact and the joins around it.

The as-of join is always an equi join on the natural key with the validity
range as a residual condition, so Spark plans it as a hash or sort-merge join
on the key, never as a nested loop.  Whether a dimension is broadcast is left to
table statistics and AQE.  A user with a large share of events is split by AQE's
skew join when both sides have an exchange of their own, i.e. when the dimension is read
from its written table, as the pipeline does; the few versions of the
user are replicated to the splits.  A dimension still computed by windows on
the same key is partitioned by these and cannot be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.keys import (epoch_seconds, key_columns, packed, packed_keys, surrogate_key, unpacked,
                                      unpacked_keys)


def rating_as_of(facts: DataFrame, versions: DataFrame, key: str | tuple[str, str], t: str,
                 valid_from: str = "valid_from", valid_to: str = "valid_to",
                 how: str = "inner") -> DataFrame:
    """Attach to each fact the version of its key valid at time ``t``:
    ``fact.key = version.key and valid_from <= t < valid_to``.

    ``key`` is a column name present on both sides or a (fact_col, version_col)
    pair; ``how`` is ``inner`` or ``left``.  Version columns that collide with
    fact columns are taken from the fact."""
    fk, vk = (key, key) if isinstance(key, str) else key
    v = versions.alias("_v")
    f = facts.alias("_f")
    cond = ((F.col(f"_f.{fk}") == F.col(f"_v.{vk}"))
            & (F.col(f"_f.{t}") >= F.col(f"_v.{valid_from}"))
            & (F.col(f"_f.{t}") < F.col(f"_v.{valid_to}")))
    fact_cols = [F.col(f"_f.{c}") for c in facts.columns]
    ver_cols = [F.col(f"_v.{c}") for c in versions.columns if c not in facts.columns]
    return f.join(v, cond, how).select(*fact_cols, *ver_cols)


def fact_viewership(stg_ratings: DataFrame, dim_content: DataFrame, dim_user: DataFrame,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per rating event, joined to its title and to the user's
    version at the time of the rating.

    Only the 3 and 5 needed dimension columns enter the joins; the user side
    joins on ``user_id`` with the validity range as residual.  It comes first, so that the ratings
    are shuffled by user before they carry the key of their title.  Keys are packed until the last join is done.
    ``keep`` names columns of the ratings to stay beside those of the fact."""
    content = dim_content.select(packed("content_sk").alias("content_sk"), "movie_id", "release_year")
    users = dim_user.select(packed("user_sk").alias("user_sk"), F.col("user_id").alias("_uid"), "membership_tier",
                            "valid_from", "valid_to")
    r = stg_ratings.join(users, (stg_ratings.user_id == users._uid)
                         & (stg_ratings.rated_at >= users.valid_from) & (stg_ratings.rated_at < users.valid_to))
    j = r.join(content, "movie_id")
    day = F.to_date("rated_at")
    return j.select(
        surrogate_key("user_id", "movie_id", epoch_seconds("rated_at")).alias("rating_sk"),
        unpacked("user_sk").alias("user_sk"), unpacked("content_sk").alias("content_sk"),
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int").alias("date_sk"),
        "rating_value", "is_positive", "rated_at",
        F.year(day).alias("rating_year"),
        F.month(day).alias("rating_month"),
        F.when(F.col("release_year").isNotNull(),
               F.datediff(day, F.make_date(F.col("release_year"), F.lit(1), F.lit(1))))
         .alias("days_since_release"),
        F.col("membership_tier").alias("membership_tier_at_rating"), *keep)


def orphan_facts(fact: DataFrame, dim: DataFrame, key: str = "content_sk",
                 fact_id: str = "rating_sk") -> DataFrame:
    """Facts whose key has no dimension row (anti join)."""
    return fact.select(fact_id, key).join(dim.select(key), key, "left_anti")


def attach_user_id(fact: DataFrame, dim_user: DataFrame) -> DataFrame:
    """The fact with the natural ``user_id`` of each row's user version."""
    both = packed_keys(fact).join(packed_keys(dim_user.select("user_sk", "user_id")), "user_sk")
    return unpacked_keys(both, key_columns(fact))


def latest_rating(fact: DataFrame, user_col: str = "user_id", item_col: str = "content_sk",
                  ts_col: str = "rated_at", tie_cols: tuple[str, ...] = ("rating_sk", "rating_value")) -> DataFrame:
    """Newest rating per (user, title).

    Keyed on the natural ``user_id`` (see :func:`attach_user_id`): a user who
    re-rates a title after a tier change has two user versions but one latest
    rating.  Ties on time go to the larger ``rating_sk``, then the larger value
    (two ratings in one second share a ``rating_sk``).  The row itself, its time and ties
    first, is the maximum, so each column moves once.  A maximum of structs
    is a sort aggregate on both sides of the shuffle; unlike a row_number
    window it leaves one row per (user, title) and task to move.  Keys are packed on that way, but for those
    that are compared."""
    first = [ts_col, *tie_cols]
    columns, packs = fact.columns, [c for c in key_columns(fact) if c not in first]
    fact = packed_keys(fact, but=first)
    cols = [c for c in columns if c not in (user_col, item_col)]
    pick = F.max(F.struct(*first, *[c for c in cols if c not in first]))
    latest = fact.groupBy(user_col, item_col).agg(pick.alias("_r")).select(user_col, item_col, *[f"_r.{c}" for c in cols])
    return unpacked_keys(latest, packs)


