"""Order-independent arithmetic for aggregates.

Float sums depend on the order rows arrive in, i.e. on partitioning; on a large
cluster two runs of the same job can then round a mean to different decimals.
These helpers compute from exact integer/decimal sums, so every value is the
same however the data is split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def half_up_ratio(num: Column, den: Column, precision: int, scale: int) -> Column:
    """``num / den`` rounded half-up to ``scale`` decimals, as DECIMAL(precision, scale).

    ``num`` and ``den`` must be integral and non-negative; ``den`` = 0 gives NULL.
    Computed as ``floor((2*10^s*num + den) / (2*den))`` in 38-digit decimals.
    """
    d2 = den.cast(_WIDE) * F.lit(2)
    n2 = num.cast(_WIDE) * F.lit(2 * 10 ** scale) + den.cast(_WIDE)
    quotient = (n2 - F.pmod(n2, d2)) / d2          # divides evenly: exact
    value = (quotient.cast(_WIDE) / F.lit(10 ** scale)).cast(f"decimal({precision},{scale})")
    return F.when(den > 0, value)


def exact_mean(total: Column, count: Column) -> Column:
    """Mean as DOUBLE from an exact (integral or decimal) total: one correctly
    rounded division, hence identical on every partitioning."""
    return F.when(count > 0, total.cast("double") / count.cast("double"))


def sample_stddev_from_sums(n: Column, s1: Column, s2: Column, unit: int = 1) -> Column:
    """Sample standard deviation from exact integer sums.

    ``s1`` = sum of x*unit and ``s2`` = sum of (x*unit)^2 as integers; the
    variance numerator ``n*s2 - s1^2`` is exact, so the result is one correctly
    rounded division and square root.  NULL for n < 2.
    """
    num = n.cast(_WIDE) * s2.cast(_WIDE) - s1.cast(_WIDE) * s1.cast(_WIDE)
    den = n.cast(_WIDE) * (n.cast(_WIDE) - F.lit(1)) * F.lit(unit * unit)
    return F.when(n > 1, F.sqrt(num.cast("double") / den.cast("double")))
