"""Semi-structured deliveries: JSON objects with changing fields.

Fields that the schema declares become columns; whatever else an object holds, and a declared field whose
value does not fit its type, is kept as text in a rescued map, so a new or changed field loses no data
and fails no run.  A text that is no JSON object is marked, not dropped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESCUED, MALFORMED = "_rescued", "_malformed"


def parse_object(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """``df`` with a column per declared field (null: absent or not of its type), ``_rescued`` (map of the
    rest; null if nothing is rescued) and ``_malformed``.  Nested values are rescued as JSON text."""
    parsed = F.from_json(F.col(column), "map<string,string>")
    values = {f: F.try_element_at(F.col("_fields"), F.lit(f)).try_cast(t) for f, t in fields.items()}

    def left_over(k, v):
        unfit = F.lit(False)
        for f, t in fields.items():
            unfit = unfit | ((k == f) & v.isNotNull() & v.try_cast(t).isNull())
        return ~k.isin(list(fields)) | unfit

    rest = F.map_filter("_fields", left_over)
    return df.withColumn("_fields", parsed).withColumns(
        values | {RESCUED: F.when(F.size(rest) > 0, rest),
                  MALFORMED: F.col(column).isNotNull() & F.col("_fields").isNull()}).drop("_fields")


def rescued_fields(parsed: DataFrame, *by: str) -> DataFrame:
    """(by, field, n): how often each rescued field occurs; what a schema should learn next."""
    return parsed.select(*by, F.explode(F.map_keys(RESCUED)).alias("field")).groupBy(*by, "field").agg(F.count("*").alias("n"))
