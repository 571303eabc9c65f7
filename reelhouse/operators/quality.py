"""Data-quality checks as distributed jobs.

Row-level checks (G1-G7) return the offending rows: zero rows means pass.
Scalar checks (G8-G13) are objects that contribute aggregate expressions; the
report (G14) evaluates all scalar checks of one table in a single ``agg`` pass
and turns the one aggregated row into result rows with ``explode``, so nothing
but the final few result rows ever leaves the executors.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.keys import key_columns, packed
from reelhouse.operators.facts import orphan_facts
from reelhouse.operators.history import version_overlaps

PASS, FAIL, ERROR = "pass", "fail", "error"


# --- row-level checks (G1-G7) ---------------------------------------------------
def check_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """G1: rows where any of ``cols`` is null."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-null values seen more than once, with their count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def check_accepted_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose value is outside the list (nulls pass)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*list(values)))


def check_relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join)."""
    pc = parent_col or col
    keys = parent.select(F.col(pc).alias(col))  # an anti join needs no distinct keys
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def check_rating_range(df: DataFrame, col: str = "rating_value", lo: float = 0.5, hi: float = 5.0,
                       keep: Sequence[str] = ("rating_sk",)) -> DataFrame:
    """Values outside [lo, hi]."""
    return df.filter(~F.col(col).between(lo, hi)).select(*keep, col)


def check_scd2_no_overlap(dim_user: DataFrame) -> DataFrame:
    """Overlapping versions of a user (see ``history.version_overlaps``)."""
    return version_overlaps(dim_user)


def check_no_orphans(fact: DataFrame, dim_content: DataFrame) -> DataFrame:
    """Facts whose title is missing from the content dimension."""
    return orphan_facts(fact, dim_content)


# --- scalar checks (G8-G13) -------------------------------------------------------
@dataclass
class _Scalar:
    """One scalar check: aggregates in, (status, message) columns out."""

    def name(self) -> str:
        return type(self).__name__

    def column(self) -> str | None:
        return getattr(self, "col", None)

    def aggs(self, p: str) -> list[Column]:
        raise NotImplementedError

    def verdict(self, p: str) -> tuple[Column, Column]:
        raise NotImplementedError


def _fmt(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("null"))


@dataclass
class RowCountCheck(_Scalar):
    """Min <= row count <= max."""
    min: int = 0
    max: int | None = None

    def aggs(self, p):
        return [F.count(F.lit(1)).alias(f"{p}n")]

    def verdict(self, p):
        n = F.col(f"{p}n")
        ok = n >= self.min if self.max is None else n.between(self.min, self.max)
        msg = F.concat(F.lit("rows="), _fmt(n), F.lit(f" expected [{self.min}, {self.max}]"))
        return F.when(ok, PASS).otherwise(FAIL), msg


@dataclass
class NullRateCheck(_Scalar):
    """Share of nulls in ``col`` <= threshold."""
    col: str = ""
    threshold: float = 0.0

    def aggs(self, p):
        return [F.count_if(F.col(self.col).isNull()).alias(f"{p}nulls"), F.count(F.lit(1)).alias(f"{p}n")]

    def verdict(self, p):
        rate = F.when(F.col(f"{p}n") > 0, F.col(f"{p}nulls") / F.col(f"{p}n")).otherwise(F.lit(0.0))
        msg = F.concat(F.lit("null_rate="), _fmt(F.round(rate, 6)), F.lit(f" threshold {self.threshold}"))
        return F.when(rate <= self.threshold, PASS).otherwise(FAIL), msg


@dataclass
class RangeCheck(_Scalar):
    """All non-null values within [min_val, max_val]."""
    col: str = ""
    min_val: float | None = None
    max_val: float | None = None

    def aggs(self, p):
        return [F.min(self.col).alias(f"{p}lo"), F.max(self.col).alias(f"{p}hi")]

    def verdict(self, p):
        lo, hi = F.col(f"{p}lo"), F.col(f"{p}hi")
        ok = F.lit(True)
        if self.min_val is not None:
            ok = ok & (lo.isNull() | (lo >= self.min_val))
        if self.max_val is not None:
            ok = ok & (hi.isNull() | (hi <= self.max_val))
        msg = F.concat(F.lit("min="), _fmt(lo), F.lit(" max="), _fmt(hi),
                       F.lit(f" bounds [{self.min_val}, {self.max_val}]"))
        return F.when(ok, PASS).otherwise(FAIL), msg


@dataclass
class UniquenessCheck(_Scalar):
    """Duplicate share ``1 - distinct/non-null`` <= threshold."""
    col: str = ""
    threshold: float = 0.0

    def aggs(self, p):
        return [F.count_distinct(self.col).alias(f"{p}d"), F.count(self.col).alias(f"{p}nn")]

    def verdict(self, p):
        nn, d = F.col(f"{p}nn"), F.col(f"{p}d")
        dup = F.when(nn > 0, F.lit(1.0) - d / nn).otherwise(F.lit(0.0))
        msg = F.concat(F.lit("duplicate_share="), _fmt(F.round(dup, 6)), F.lit(f" threshold {self.threshold}"))
        return F.when(dup <= self.threshold, PASS).otherwise(FAIL), msg


@dataclass
class DistributionCheck(_Scalar):
    """``|mean - baseline_mean| / stddev`` <= z (stddev 0 or null: the
    mean must equal the baseline)."""
    col: str = ""
    baseline_mean: float = 0.0
    z_score_threshold: float = 3.0

    def aggs(self, p):
        x = F.col(self.col).cast("double")
        return [F.avg(x).alias(f"{p}mean"), F.stddev_samp(x).alias(f"{p}sd")]

    def verdict(self, p):
        mean, sd = F.col(f"{p}mean"), F.col(f"{p}sd")
        dev = F.abs(mean - F.lit(self.baseline_mean))
        z = F.when(sd > 0, dev / sd)
        ok = (F.when(sd > 0, z <= self.z_score_threshold)
              .otherwise(mean.isNull() | (dev == 0)))
        msg = F.concat(F.lit("z="), _fmt(F.round(z, 6)), F.lit(f" threshold {self.z_score_threshold}"))
        return F.when(ok, PASS).otherwise(FAIL), msg


@dataclass
class SchemaCheck:
    """Expected column -> Spark type (simple string); extra columns allowed.

    Reads only the schema (no job)."""
    expected: Mapping[str, str]

    def mismatches(self, df: DataFrame) -> list[tuple[str, str, str | None]]:
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        return [(c, t, actual.get(c)) for c, t in self.expected.items() if actual.get(c) != t]


def check_schema(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """G10 as a DataFrame: one row per expected column with its actual type (null: missing), the rows
    of the table and the column's nulls, from one aggregation over the expected columns."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    there = [c for c in expected if c in actual]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(there)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("expected_type"), F.lit(actual.get(c)).cast("string").alias("actual_type"),
                     F.lit(PASS if actual.get(c) == t else FAIL).alias("status"), F.col("_rows").alias("n_rows"),
                     (F.col("_rows") - F.col(f"_n{there.index(c)}") if c in actual else F.lit(None)).cast("long").alias("n_nulls"))
            for c, t in expected.items()]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_row_count(df: DataFrame, min: int = 0, max: int | None = None) -> DataFrame:
    """G8 as a one-row verdict."""
    return quality_report(df, [RowCountCheck(min, max)], with_overall=False)


def check_null_rate(df: DataFrame, col: str, threshold: float = 0.0) -> DataFrame:
    return quality_report(df, [NullRateCheck(col, threshold)], with_overall=False)


def check_range(df: DataFrame, col: str, min_val=None, max_val=None) -> DataFrame:
    return quality_report(df, [RangeCheck(col, min_val, max_val)], with_overall=False)


def check_uniqueness(df: DataFrame, col: str, threshold: float = 0.0) -> DataFrame:
    return quality_report(df, [UniquenessCheck(col, threshold)], with_overall=False)


def check_distribution(df: DataFrame, col: str, baseline_mean: float, z_score_threshold: float) -> DataFrame:
    return quality_report(df, [DistributionCheck(col, baseline_mean, z_score_threshold)], with_overall=False)


# --- the fused report (G14) ---------------------------------------------------------
def quality_report(df: DataFrame, checks: Sequence, with_overall: bool = True) -> DataFrame:
    """Check, status, column, message for every check; plus, with
    ``with_overall``, a final ``overall`` row whose message holds the row count.

    All scalar checks share one aggregation over ``df``; schema checks read
    metadata; a check naming a missing column reports ``error``.  Keys that are only counted are packed."""
    cols = set(df.columns)
    read = {c.column() for c in checks if not isinstance(c, (SchemaCheck, UniquenessCheck, NullRateCheck))}
    unique = {c.col for c in checks if isinstance(c, UniquenessCheck)}
    counted = [c for c in key_columns(df) if c in unique - read]
    table = df.withColumns({c: packed(c) for c in counted})
    aggs: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    results: list[Column] = []
    for i, chk in enumerate(checks):
        p = f"_c{i}_"
        if isinstance(chk, SchemaCheck):
            bad = chk.mismatches(df)
            status = PASS if not bad else FAIL
            msg = "schema ok" if not bad else "; ".join(f"{c}: expected {t}, got {a}" for c, t, a in bad)
            results.append(F.struct(F.lit("SchemaCheck").alias("check"), F.lit(status).alias("status"),
                                    F.lit(None).cast("string").alias("column"), F.lit(msg).alias("message")))
            continue
        col = chk.column()
        if col is not None and col not in cols:
            results.append(F.struct(F.lit(chk.name()).alias("check"), F.lit(ERROR).alias("status"),
                                    F.lit(col).alias("column"),
                                    F.lit(f"column {col} not found").alias("message")))
            continue
        aggs.extend(chk.aggs(p))
        status, msg = chk.verdict(p)
        results.append(F.struct(F.lit(chk.name()).alias("check"), status.alias("status"),
                                F.lit(col).cast("string").alias("column"), msg.alias("message")))
    checks_arr = F.array(*results)
    if with_overall:
        # decided from the same aggregated row: the table is scanned once
        overall = F.struct(
            F.lit("overall").alias("check"),
            F.when(F.exists(checks_arr, lambda r: r["status"] != PASS), F.lit(FAIL))
             .otherwise(F.lit(PASS)).alias("status"),
            F.lit(None).cast("string").alias("column"),
            F.concat(F.lit("rows="), F.col("_rows").cast("string")).alias("message"))
        checks_arr = F.concat(checks_arr, F.array(overall))
    return table.agg(*aggs).select(F.explode(checks_arr).alias("r")).select("r.*")


def raise_on_fail(report: DataFrame) -> DataFrame:
    """Action: raise if any row of a report failed (the reference only reports)."""
    failed = report.filter(F.col("status") != PASS).collect()  # a row per check
    if failed:
        raise AssertionError("quality checks failed: " + "; ".join(
            f"{r['check']}({r['column']}): {r['message']}" for r in failed))
    return report


# --- contracts: which checks guard which gold table -----------------------------------
ERAS = ["classic", "modern", "contemporary", "recent"]
TIERS = ["basic", "standard", "premium"]
REGIONS = ["NA", "EU", "APAC", "LATAM"]

MART_SCHEMA = {
    "content_sk": "string", "movie_id": "string", "title": "string", "release_year": "int",
    "era": "string", "primary_genre": "string", "total_ratings": "bigint",
    "avg_rating": "decimal(4,2)", "pct_positive": "decimal(5,2)", "weighted_score": "decimal(6,4)",
}


def gold_mart_checks(min_rows: int = 1_000, max_rows: int = 200_000, max_year: int = 2026) -> list:
    return [
        RowCountCheck(min_rows, max_rows),
        NullRateCheck("content_sk", 0.0), NullRateCheck("avg_rating", 0.0),
        NullRateCheck("primary_genre", 0.0),
        SchemaCheck(MART_SCHEMA),
        RangeCheck("avg_rating", 0.5, 5.0), RangeCheck("pct_positive", 0.0, 100.0),
        RangeCheck("release_year", 1888, max_year),
        UniquenessCheck("content_sk", 0.0), UniquenessCheck("movie_id", 0.0),
        DistributionCheck("avg_rating", 3.5, 4.0),
    ]


def fact_checks(min_rows: int = 10_000_000, max_rows: int = 30_000_000) -> list:
    return [
        RowCountCheck(min_rows, max_rows),
        NullRateCheck("rating_sk", 0.0), NullRateCheck("user_sk", 0.0), NullRateCheck("content_sk", 0.0),
        RangeCheck("rating_value", 0.5, 5.0),
        UniquenessCheck("rating_sk", 0.0),
    ]


# Fixed values (with the check lists above): the column contracts of the gold tables.
CONTRACTS = {
    "dim_content": {"not_null": ["content_sk", "movie_id", "release_year", "era", "primary_genre"],
                    "unique": ["content_sk", "movie_id"], "accepted": {"era": ERAS}},
    "dim_user": {"not_null": ["user_sk", "user_id", "is_current"], "unique": ["user_sk"],
                 "accepted": {"membership_tier": TIERS, "region": REGIONS}},
    "dim_date": {"not_null": ["date_sk", "full_date", "quarter"], "unique": ["date_sk", "full_date"],
                 "accepted": {"quarter": [1, 2, 3, 4]}},
    "fact_viewership": {"not_null": ["rating_sk", "user_sk", "content_sk", "date_sk", "rating_value"],
                        "unique": ["rating_sk"], "accepted": {},
                        "rel": [("user_sk", "dim_user"), ("content_sk", "dim_content"), ("date_sk", "dim_date")]},
    "mart_content_performance": {"not_null": ["content_sk", "total_ratings", "avg_rating"],
                                 "unique": ["content_sk"], "accepted": {}},
}


def contract_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column contracts of the gold tables as one DataFrame of
    (table, column, test, violations): not_null, unique, accepted_values and
    relationships.

    Each table is evaluated once for all its tests but further unique columns: a row is a short entry
    for each key (its first unique column and its references), entries are counted by key before they are moved, and
    only keys meet the keys of the parents.  A second unique column needs a grouping of its
    own.  Give the written tables: a lazy fact would be computed for every
    table that refers to it."""
    parts: list[DataFrame] = []
    for table, s in CONTRACTS.items():
        if table not in tables:
            continue
        df = tables[table]
        tests = [(c, "not_null", F.col(c).isNull()) for c in s["not_null"]]
        tests += [(c, "accepted_values", F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in s["accepted"].items()]
        first, *others = s["unique"]
        rel = [(c, parent) for c, parent in s.get("rel", []) if parent in tables]
        flags = [f"_v{i}" for i in range(len(tests))]
        # kind 0 is the unique column, with what the row alone tells; kind i the i-th reference
        entry = [F.struct(F.lit(0).alias("_kind"), packed(F.col(first).cast("string")).alias("_key"),
                          *[F.coalesce(t, F.lit(False)).alias(v) for (_, _, t), v in zip(tests, flags)])]
        entry += [F.struct(F.lit(i).alias("_kind"), packed(F.col(c).cast("string")).alias("_key"), *[F.lit(False).alias(v) for v in flags])
                  for i, (c, _) in enumerate(rel, 1)]
        entries = (df.select(F.explode(F.array(*entry)).alias("e")) if rel else df.select(entry[0].alias("e"))).select("e.*")
        groups = entries.groupBy("_kind", "_key").agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(v).alias(v) for v in flags])
        if rel:
            # a parent key that occurs twice must not double its children
            marks = [tables[parent].select(F.lit(i).alias("_kind"), packed(F.col(c).cast("string")).alias("_key"))
                     for i, (c, parent) in enumerate(rel, 1)]
            known = reduce(DataFrame.unionByName, marks).distinct().withColumn("_known", F.lit(True))
            groups = groups.join(known, ["_kind", "_key"], "left")
        found = [F.struct(F.lit(c).alias("column"), F.lit(test).alias("test"), F.coalesce(F.sum(v), F.lit(0)).alias("violations"))
                 for (c, test, _), v in zip(tests, flags)]
        keyed = F.col("_key").isNotNull()
        found += [F.struct(F.lit(c).alias("column"), F.lit("relationships").alias("test"),
                           F.coalesce(F.sum(F.when((F.col("_kind") == i) & keyed & F.col("_known").isNull(), F.col("_n"))), F.lit(0))
                           .alias("violations")) for i, (c, _) in enumerate(rel, 1)]
        found.append(F.struct(F.lit(first).alias("column"), F.lit("unique").alias("test"),
                              F.count_if((F.col("_kind") == 0) & keyed & (F.col("_n") > 1)).alias("violations")))
        parts.append(groups.agg(F.array(*found).alias("a")).select(F.explode("a").alias("r"))
                     .select(F.lit(table).alias("table"), "r.*"))
        for c in others:
            parts.append(check_unique(tables[table], c).agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(table).alias("table"), F.lit(c).alias("column"),
                                 F.lit("unique").alias("test"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
