"""The daily run as one Spark application (L2).

source counts -> silver -> user history -> dimensions -> fact -> mart ->
checks -> audit row (written even when a step fails).

Sources are files as delivered (CSV, :class:`SourceFiles`) or the driver's tables.
A delivered users file holds the current state only; its capture is merged into the
stored history (C1), so the history survives from run to run.

Gold tables are written once, to a folder of the run, and read back, so the fact is
scanned from storage (column-pruned) by the mart and the checks instead of being
recomputed from its lineage.  A run becomes visible when its folder is appended to
the log of the gold layer; a run that fails midway leaves the last one in place.

With ``incremental`` the delivered ratings are what is new (or late, or delivered again): the fact of
the last run is taken over year by year, only touched years are written (``streaming.fact_parts``),
and changed titles and users are carried into the rows that have them.

Lines of the delivered files that do not fit their schema are in no table: they are kept in the run's
folder and counted per source, and a run with any has the status ``fail``.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators import history, quality, silver
from reelhouse.operators import mart as mart_ops
from reelhouse.plans.gold import GoldBuild
from reelhouse.session import size_shuffles_for
from reelhouse.sources import counts as counts_src
from reelhouse.sources import files, records, sinks
from reelhouse.streaming import fact_parts

LOG = "_log"


@dataclass
class SourceFiles:
    """Paths of the delivered files; ``captured_at`` is the time of the users file.  With ``split_text`` the
    free-text files (movies, tags) are read in splits; they must then follow RFC 4180 (see ``sources.records``)."""
    ratings: str
    movies: str
    tags: str
    users: str
    captured_at: str
    split_text: bool = False

    def scan_movies(self, spark: SparkSession, path: str) -> DataFrame:
        return (records.scan_records(spark, path, files.MOVIES_SCHEMA) if self.split_text
                else files.scan_movies(spark, path))

    def scan_tags(self, spark: SparkSession, path: str) -> DataFrame:
        return records.scan_records(spark, path, files.TAGS_SCHEMA) if self.split_text else files.scan_tags(spark, path)

    def counts(self, spark: SparkSession) -> DataFrame:
        return counts_src.source_row_counts(spark, {
            "ratings": (files.scan_ratings, self.ratings), "movies": (self.scan_movies, self.movies),
            "tags": (self.scan_tags, self.tags), "users": (files.scan_users, self.users)})

    def rejected(self, spark: SparkSession) -> DataFrame:
        """(source, file, line): the lines that the scans leave out; a missing path has none."""
        parts = [spark.createDataFrame([], "source string, file string, line string")]
        for name, path, schema in (("ratings", self.ratings, files.RATINGS_SCHEMA), ("movies", self.movies, files.MOVIES_SCHEMA),
                                   ("tags", self.tags, files.TAGS_SCHEMA), ("users", self.users, files.USERS_SCHEMA)):
            try:
                split = self.split_text and name in ("movies", "tags")
                bad = (records.rejected_records if split else files.rejected)(spark, path, schema)
                parts.append(bad.select(F.lit(name).alias("source"), "file", "line"))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        return reduce(DataFrame.unionByName, parts)


@dataclass
class GoldTables:
    """Paths of a materialized gold layer and readers for them."""
    root: str
    timings: dict[str, float] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        parts = self.parts(spark) if name == "fact_viewership" else None
        if parts is None:
            return spark.read.parquet(self.path(name))
        return fact_parts.read_parts(spark, parts, self.read(spark, "fact_schema").schema)

    def parts(self, spark: SparkSession) -> fact_parts.Parts | None:
        """Where the years of an incremental run's fact lie; None after a full run."""
        rows = read_or_none(spark, self.path("fact_parts"), "year int, folder string")
        return None if rows is None else [tuple(r) for r in rows.collect()]


def read_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def publish(spark: SparkSession, out_root: str, name: str, path: str) -> None:
    """Make ``path`` the current version of ``name`` (one appended log row)."""
    row = spark.range(1).select(F.lit(name).alias("name"), F.lit(path).alias("path"),
                                F.unix_micros(F.current_timestamp()).alias("at"))
    row.write.mode("append").parquet(f"{out_root}/{LOG}")


def current(spark: SparkSession, out_root: str, name: str) -> str | None:
    """Path of the current version of ``name``; None if there has been none."""
    log = read_or_none(spark, f"{out_root}/{LOG}", "name string, path string, at long")
    if log is None:
        return None
    row = log.filter(F.col("name") == name).agg(F.max_by("path", "at").alias("path")).first()
    return row["path"]


def update_user_history(spark: SparkSession, out_root: str, users: str, captured_at: str) -> DataFrame:
    """Merge a delivered users file into the stored history (C1) and publish the result."""
    raw = files.scan_users(spark, users).withColumn("capture_ts", F.lit(captured_at).cast("timestamp"))
    path = current(spark, out_root, "user_snapshot")
    stored = spark.read.parquet(path) if path else None
    merged = history.scd2_capture(stored, silver.stage_users(raw), captured_at)
    fresh = f"{out_root}/user_snapshot/{uuid.uuid4().hex}"
    sinks.write_gold(merged, fresh)
    publish(spark, out_root, "user_snapshot", fresh)
    return spark.read.parquet(fresh)


def check_sources(spark: SparkSession, src: SourceFiles, root: str) -> DataFrame:
    """A report row per source, ``fail`` if lines were rejected; these and the report are kept under ``root``."""
    sinks.write_gold(src.rejected(spark), f"{root}/rejected_lines")
    counts = spark.read.parquet(f"{root}/rejected_lines").groupBy(F.col("source").alias("column")).agg(F.count("*").alias("n"))
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, ("ratings", "movies", "tags", "users")))).alias("column"))
    n = F.coalesce("n", F.lit(0))
    report = names.join(counts, "column", "left").select(
        F.lit("RejectedLines").alias("check"), F.when(n == 0, quality.PASS).otherwise(quality.FAIL).alias("status"),
        "column", F.concat(F.lit("rejected="), n.cast("string")).alias("message"))
    sinks.write_gold(report, f"{root}/quality_sources")
    return spark.read.parquet(f"{root}/quality_sources")


def gold_of_files(spark: SparkSession, src: SourceFiles, snapshot: DataFrame) -> GoldBuild:
    """The lazy gold build over delivered files and a user history."""
    return GoldBuild(spark, "", overrides={
        "raw_ratings": files.scan_ratings(spark, src.ratings), "raw_movies": src.scan_movies(spark, src.movies),
        "raw_tags": src.scan_tags(spark, src.tags), "user_snapshot": snapshot})


def run_concurrently(*steps) -> list:
    """Run independent Spark steps as concurrent jobs of one application (the
    scheduler interleaves their tasks); re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(step) for step in steps]
        return [f.result() for f in futures]


def advance_fact(spark: SparkSession, last: GoldTables | None, out: GoldTables, arrived: DataFrame, schema) -> None:
    """Write the fact of an incremental run: its touched years, its pending ratings and the list of all parts."""
    def was(name):
        return last.read(spark, name) if last else None

    parts, pending = [], None
    if last:
        parts = last.parts(spark)
        if parts is None:
            parts = fact_parts.parts_of(spark, last.path("fact_viewership"))
        events = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in arrived.select(*fact_parts.EVENT).schema)
        pending = read_or_none(spark, last.path("pending_ratings"), events)
    parts = fact_parts.advance_fact(spark, parts, out.path("fact_viewership"), out.path("pending_ratings"), arrived, pending,
                                    out.read(spark, "dim_content"), out.read(spark, "dim_user"), was("dim_content"), was("dim_user"))
    sinks.write_gold(spark.createDataFrame([], schema), out.path("fact_schema"))
    sinks.write_gold(spark.createDataFrame(parts, "year int, folder string").coalesce(1), out.path("fact_parts"))


def materialize_gold(g: GoldBuild, root: str, fact_partition_by=("rating_year",), last: GoldTables | None = None,
                     incremental: bool = False) -> GoldTables:
    """Write dims, fact (partitioned by year), histogram and mart under ``root``; with ``incremental`` the
    fact is that of the run ``last`` (None: there was none) with the ratings of ``g`` brought in."""
    spark = g.spark
    out = GoldTables(root.rstrip("/"))

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        out.timings[name] = time.perf_counter() - t0

    def user_dims():
        sinks.write_gold(g.user_snapshot, out.path("user_snapshot"))
        sinks.write_gold(history.dim_user(spark.read.parquet(out.path("user_snapshot"))), out.path("dim_user"))

    # the three dimension builds are independent: submit them as concurrent jobs
    timed("dims_build", lambda: run_concurrently(
        user_dims,
        lambda: sinks.write_gold(g.dim_content, out.path("dim_content")),
        lambda: sinks.write_gold(g.dim_date, out.path("dim_date"))))
    dim_user = out.read(spark, "dim_user")
    dim_content = out.read(spark, "dim_content")
    gf = GoldBuild(spark, g.sf_dir, g.current_year, g.capture_dates, g.prior,
                   overrides={**g.overrides, "dim_user": dim_user, "dim_content": dim_content,
                              "raw_ratings": g.raw_ratings})
    timed("fact_build", lambda: advance_fact(spark, last, out, gf.stg_ratings, gf.fact.schema) if incremental else
          sinks.write_gold(gf.fact, out.path("fact_viewership"), list(fact_partition_by)))
    fact = out.read(spark, "fact_viewership")

    def build_mart():
        # what the mart takes from the fact, reduced in two concurrent jobs
        run_concurrently(
            lambda: sinks.write_gold(mart_ops.rating_histogram(fact), out.path("rating_histogram")),
            lambda: sinks.write_gold(mart_ops.title_audience(fact, dim_user), out.path("title_audience")))
        hist, audience = out.read(spark, "rating_histogram"), out.read(spark, "title_audience")
        sinks.write_gold(mart_ops.mart_content_performance(fact, dim_content, dim_user, prior=g.prior, hist=hist, audience=audience),
                         out.path("mart_content_performance"))
    timed("mart_build", build_mart)
    return out


def check_gold(spark: SparkSession, tables: GoldTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mart report, fact report, contract violations) of written gold tables, each
    evaluated once and kept with them."""
    lazy = {"quality_mart": quality.quality_report(tables.read(spark, "mart_content_performance"),
                                                   quality.gold_mart_checks()),
            "quality_fact": quality.quality_report(tables.read(spark, "fact_viewership"), quality.fact_checks()),
            "contracts": quality.contract_violations({n: tables.read(spark, n) for n in quality.CONTRACTS})}
    for name, df in lazy.items():
        sinks.write_gold(df, tables.path(name))
    return tuple(tables.read(spark, name) for name in lazy)


def run_pipeline(spark: SparkSession, sources: str | SourceFiles, out_root: str, run_id: str,
                 raise_on_fail: bool = False, input_bytes: int | None = None, incremental: bool = False) -> dict:
    """Build, check and publish the gold layer; append the audit row in any case.

    ``incremental``: the ratings are a delivery to bring into the last published fact (titles and users
    are delivered whole).  Ratings without a title or user wait for one from run to run; a full run
    starts anew from its own sources and leaves none waiting.

    ``sources`` names delivered files, or a folder with the driver's tables.
    ``input_bytes`` (size of the raw inputs, if known) sizes the initial shuffle partition
    count for AQE.  The status is ``pass`` only if the reports and all contracts pass; with
    ``raise_on_fail`` a failed run raises and is not published (with rejected lines, before the
    stored user history is touched).  ``source_report`` is None for a folder of tables."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(initial, None)
    if input_bytes:
        size_shuffles_for(spark, input_bytes)
    out_root = out_root.rstrip("/")
    root = f"{out_root}/runs/{run_id}-{uuid.uuid4().hex[:8]}"
    counts = report = source_report = None
    status = None
    try:
        if isinstance(sources, SourceFiles):
            counts = sources.counts(spark)
            source_report = check_sources(spark, sources, root)
            if not source_report.filter(F.col("status") != quality.PASS).isEmpty():
                status = "fail"
            if raise_on_fail:
                quality.raise_on_fail(source_report)
            snapshot = update_user_history(spark, out_root, sources.users, sources.captured_at)
            g = gold_of_files(spark, sources, snapshot)
        else:
            g = GoldBuild(spark, sources)
            counts = counts_src.source_row_counts(spark, {
                name: (lambda _, df: df, df) for name, df in
                (("ratings", g.raw_ratings), ("movies", g.raw_movies), ("tags", g.raw_tags),
                 ("users", g.raw_user_captures))})
        tables = materialize_gold(g, root, last=current_gold(spark, out_root) if incremental else None, incremental=incremental)
        report, fact_report, contracts = check_gold(spark, tables)
        bad = report.filter("status <> 'pass'").count() + fact_report.filter("status <> 'pass'").count()
        status = "fail" if status or bad or not contracts.filter("violations > 0").isEmpty() else "pass"
        if raise_on_fail:
            quality.raise_on_fail(report)
            quality.raise_on_fail(fact_report)
            if status == "fail":
                raise AssertionError("column contracts are violated")
        publish(spark, out_root, "gold", tables.root)
        return {"tables": tables, "report": report, "fact_report": fact_report, "contracts": contracts,
                "source_report": source_report, "status": status}
    finally:
        sinks.append_run_audit(spark, f"{out_root}/_audit/runs", run_id, counts, report, status=status)
        if input_bytes:  # leave the caller's session as it was
            spark.conf.unset(initial) if before is None else spark.conf.set(initial, before)


def current_gold(spark: SparkSession, out_root: str) -> GoldTables | None:
    """The gold layer of the last published run."""
    path = current(spark, out_root.rstrip("/"), "gold")
    return GoldTables(path) if path else None
