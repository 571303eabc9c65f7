"""Set operations over gold tables: relational division, and the difference of two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def complete_raters(fact: DataFrame, dim_user: DataFrame, dim_content: DataFrame,
                    by: Sequence[str] = ("primary_genre", "era"), min_titles: int = 2) -> DataFrame:
    """(user_id, group columns, n_titles): users who rated *every* title of a group of at least ``min_titles``.

    Division by counting: a user's distinct rated titles of a group against the group's titles, rated
    by anyone or not.  Repeated ratings and user versions are made distinct first, so a hot title
    counts once per user; nothing is compared title by title."""
    titles = dim_content.select("content_sk", *by)
    sizes = titles.distinct().groupBy(*by).agg(F.count("*").alias("n_titles")).filter(F.col("n_titles") >= min_titles)
    rated = (fact.select("content_sk", "user_sk").distinct().join(dim_user.select("user_sk", "user_id"), "user_sk")
             .select("user_id", "content_sk").distinct())
    counted = rated.join(titles, "content_sk").groupBy("user_id", *by).agg(F.count("*").alias("_rated"))
    return counted.join(sizes, list(by)).filter("_rated = n_titles").select("user_id", *by, "n_titles")


def run_difference(before: DataFrame, after: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """(key, change, n, changed_columns): what ``after`` has ``added``, ``removed`` or ``changed``.

    Rows are compared as multisets: equal rows cancel out in one grouping, so only rows that differ go on.
    A key with one row on each side is a change, with the columns whose values differ (null-safe); any
    other difference is rows added or removed, n of them.  Columns must have comparable types."""
    cols = [c for c in after.columns if c not in ignore]
    rest = [c for c in cols if c not in key]
    both = (before.select(*cols).withColumn("_n", F.lit(-1).cast("long"))
            .unionByName(after.select(*cols).withColumn("_n", F.lit(1).cast("long"))))
    left = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    gone, come = F.col("_n") < 0, F.col("_n") > 0
    per_key = left.groupBy(*key).agg(
        F.sum(F.when(gone, -F.col("_n")).otherwise(0)).alias("_gone"), F.sum(F.when(come, F.col("_n")).otherwise(0)).alias("_come"),
        F.max(F.when(gone, F.struct(*rest))).alias("_old"), F.max(F.when(come, F.struct(*rest))).alias("_new"))
    one = (F.col("_gone") == 1) & (F.col("_come") == 1)
    names = F.array_compact(F.array(*[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in rest]))
    none = F.array().cast("array<string>")

    def change(name, n, columns=none):
        return F.struct(F.lit(name).alias("change"), n.cast("long").alias("n"), columns.alias("changed_columns"))

    rows = F.when(one, F.array(change("changed", F.lit(1), names))).otherwise(
        F.filter(F.array(change("removed", F.col("_gone")), change("added", F.col("_come"))), lambda r: r["n"] > 0))
    return per_key.select(*key, F.explode(rows).alias("r")).select(*key, "r.*")
