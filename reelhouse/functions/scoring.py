"""Era buckets (B3) and the Bayesian-weighted score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Era boundaries (exclusive upper years) and names.
ERA_BOUNDS = ((1980, "classic"), (2000, "modern"), (2015, "contemporary"))
ERA_LAST = "recent"
ERAS = ("classic", "modern", "contemporary", "recent")


def era_bucket(year) -> Column:
    """<1980 classic, <2000 modern, <2015 contemporary, else recent."""
    y = F.col(year) if isinstance(year, str) else year
    expr = None
    for bound, name in ERA_BOUNDS:
        expr = F.when(y < bound, F.lit(name)) if expr is None else expr.when(y < bound, F.lit(name))
    return expr.otherwise(F.lit(ERA_LAST))


def bayesian_score(n: Column, total: Column, prior_count: Column, prior_mean: Column) -> Column:
    """``(C*m + n*avg) / (C + n)`` with ``n*avg`` given as the exact ``total``;
    NULL when ``C + n`` is 0."""
    den = prior_count + n.cast("double")
    return F.when(den != 0, (prior_count * prior_mean + total.cast("double")) / den)
