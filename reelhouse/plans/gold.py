"""The medallion build over the driver tables, as lazy DataFrames.

``GoldBuild`` wires sources -> silver -> history -> dimensions -> fact -> mart.
Nothing runs until a result is used; :meth:`GoldBuild.mart` runs one small
action for the prior.  ``materialize`` writes the gold tables (see
``plans.pipeline``) when several queries reuse them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from reelhouse.operators import dims, facts, history, mart, silver
from reelhouse.session import apply_defaults
from reelhouse.sources import fixtures

# Fixed value: the dimension stamp used for reproducible outputs.
FIXED_UPDATED_AT = "2026-01-01 00:00:00"


@dataclass
class GoldBuild:
    spark: SparkSession
    sf_dir: str
    current_year: int = silver.DEFAULT_CURRENT_YEAR
    capture_dates: tuple[str, ...] = fixtures.CAPTURE_DATES
    prior: str = "value_bucket"
    overrides: dict = field(default_factory=dict)

    def __post_init__(self):
        apply_defaults(self.spark)

    def _get(self, name, make):
        return self.overrides[name] if name in self.overrides else make()

    # bronze ---------------------------------------------------------------
    @cached_property
    def raw_ratings(self) -> DataFrame:
        return self._get("raw_ratings", lambda: fixtures.fx_ratings(self.spark, self.sf_dir))

    @cached_property
    def raw_movies(self) -> DataFrame:
        return self._get("raw_movies", lambda: fixtures.fx_movies(self.spark, self.sf_dir))

    @cached_property
    def raw_tags(self) -> DataFrame:
        return self._get("raw_tags", lambda: fixtures.fx_tags(self.spark, self.sf_dir))

    @cached_property
    def raw_user_captures(self) -> DataFrame:
        return self._get("raw_user_captures",
                         lambda: fixtures.fx_user_captures(self.spark, self.sf_dir, self.capture_dates))

    # silver ---------------------------------------------------------------
    @cached_property
    def stg_ratings(self) -> DataFrame:
        return silver.stage_ratings(self.raw_ratings)

    @cached_property
    def stg_movies(self) -> DataFrame:
        return silver.stage_movies(self.raw_movies, self.current_year)

    @cached_property
    def stg_tags(self) -> DataFrame:
        return silver.stage_tags(self.raw_tags)

    @cached_property
    def stg_user_captures(self) -> DataFrame:
        return silver.stage_users(self.raw_user_captures)

    # history and dimensions -----------------------------------------------
    @cached_property
    def user_snapshot(self) -> DataFrame:
        return self._get("user_snapshot", lambda: history.scd2_from_captures(self.stg_user_captures))

    @cached_property
    def dim_user(self) -> DataFrame:
        return self._get("dim_user", lambda: history.dim_user(self.user_snapshot))

    @cached_property
    def dim_content(self) -> DataFrame:
        return self._get("dim_content", lambda: dims.dim_content(self.stg_movies, FIXED_UPDATED_AT))

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark)

    # fact and mart ----------------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        return self._get("fact", lambda: facts.fact_viewership(self.stg_ratings, self.dim_content,
                                                                self.dim_user))

    @cached_property
    def histogram(self) -> DataFrame:
        return self._get("histogram", lambda: mart.rating_histogram(self.fact))

    @cached_property
    def mart(self) -> DataFrame:
        return self._get("mart", lambda: mart.mart_content_performance(
            self.fact, self.dim_content, self.dim_user, prior=self.prior, hist=self.histogram))
