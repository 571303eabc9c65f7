import pytest

from reelhouse.plans.analyst_sql import ANALYST_SQL, analyst_sql, register_gold_views
from reelhouse.plans.gold import GoldBuild


def test_sql_and_dataframe_forms_agree(spark):
    from reelhouse.operators import analytics
    g = GoldBuild(spark, "/root/testdata/sf0.001")
    register_gold_views({"fact_viewership": g.fact, "mart_content_performance": g.mart, "dim_user": g.dim_user})
    assert set(ANALYST_SQL) == {"top_titles", "rating_trend_yoy", "genre_popularity", "tier_behavior",
                                "era_analysis", "user_cohorts", "controversial_titles", "tier_change_history"}
    a = analyst_sql(spark, "top_titles", min_ratings=20).collect()
    b = analytics.top_titles(g.mart, min_ratings=20).collect()
    assert a == b and len(a) == 10
    c = analyst_sql(spark, "tier_change_history").collect()
    d = analytics.tier_change_history(g.dim_user).collect()
    assert c == d


def test_parameters_must_be_numbers(spark):
    with pytest.raises(TypeError):
        analyst_sql(spark, "top_titles", min_ratings="1; DROP VIEW x")
