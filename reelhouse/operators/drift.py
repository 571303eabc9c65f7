"""Two-sample drift (beside G13): how far a column's distribution moved between two runs.

Both samples are counted in cells that they share: numbers in buckets of equal width between the smallest and
the largest value of either, other columns by value.  One pass finds the bounds, one counts all
columns at once with partial aggregation; everything after that works on a few cells per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def drift(before: DataFrame, after: DataFrame, numeric: Sequence[str], other: Sequence[str] = (), buckets: int = 20,
          psi_limit: float = 0.2) -> DataFrame:
    """(column, n_before, n_after, psi, ks, status) for every column.

    ``psi`` is the population stability index over the cells, each cell's count raised by a half so that an
    empty one stays finite; ``ks`` the largest distance of the two cumulative shares at a bucket's end (numbers
    only).  Nulls are a cell of their own.  ``status`` is ``fail`` beyond ``psi_limit``.  A sample without rows
    counts as evenly spread."""
    both = (before.select(F.lit(0).alias("_side"), *numeric, *other)
            .unionByName(after.select(F.lit(1).alias("_side"), *numeric, *other)))
    x = {c: F.col(c).cast("double") for c in numeric}
    bounds = both.agg(*[f(v).alias(f"{c}_{f.__name__}") for c, v in x.items() for f in (F.min, F.max)]).first() if numeric else {}
    cells = []
    for c in numeric:
        low, high = bounds[f"{c}_min"], bounds[f"{c}_max"]
        if low is None or low == high:
            at = F.when(F.col(c).isNotNull(), F.lit(0))
        else:
            at = F.least(F.floor((x[c] - low) * buckets / (high - low)), F.lit(buckets - 1)).cast("int")
        cells.append(F.struct(F.lit(c).alias("column"), at.alias("at"), F.lit(None).cast("string").alias("value")))
    cells += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("int").alias("at"), F.col(c).cast("string").alias("value"))
              for c in other]
    counts = (both.select("_side", F.explode(F.array(*cells)).alias("c")).groupBy("c")
              .agg(F.count_if(F.col("_side") == 0).alias("b"), F.count_if(F.col("_side") == 1).alias("a")).select("c.*", "b", "a"))
    whole = Window.partitionBy("column")
    upto = whole.orderBy(F.col("at").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, 0)
    sums = counts.withColumns({"n_before": F.sum("b").over(whole), "n_after": F.sum("a").over(whole), "cells": F.count("*").over(whole),
                               "cum_b": F.sum("b").over(upto), "cum_a": F.sum("a").over(upto)})
    p, q = ((F.col(n) + 0.5) / (F.col(total) + F.col("cells") * 0.5) for n, total in (("b", "n_before"), ("a", "n_after")))
    apart = F.abs(F.try_divide(F.col("cum_b").cast("double"), F.col("n_before")) - F.try_divide(F.col("cum_a").cast("double"), F.col("n_after")))
    out = sums.groupBy("column", "n_before", "n_after").agg(
        F.sum((q - p) * F.ln(q / p)).alias("psi"), F.max(F.when(F.col("column").isin(list(numeric)), apart)).alias("ks"))
    return out.withColumn("status", F.when(F.col("psi") > psi_limit, "fail").otherwise("pass"))
