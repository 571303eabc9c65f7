"""Column expressions (no DataFrame operations)."""

from reelhouse.functions.calendar import day_of_week_as_coded, iso_day_of_week, week_of_year_monday
from reelhouse.functions.exact import exact_mean, half_up_ratio, sample_stddev_from_sums
from reelhouse.functions.keys import epoch_seconds, surrogate_key
from reelhouse.functions.scoring import bayesian_score, era_bucket

__all__ = [
    "bayesian_score", "day_of_week_as_coded", "epoch_seconds", "era_bucket", "exact_mean",
    "half_up_ratio", "iso_day_of_week", "sample_stddev_from_sums", "surrogate_key",
    "week_of_year_monday",
]
