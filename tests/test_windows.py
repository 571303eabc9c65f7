"""Intervals, bitemporal history, grains, sessions, set operations, corrections: brute force on awkward rows."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import bitemporal, comparison, facts, history, intervals, rollups
from reelhouse.plans.gold import GoldBuild
from reelhouse.plans.registry_windows import _runs
from reelhouse.sources import fixtures, sinks
from reelhouse.streaming import incremental, ratings_stream, sessions

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2000, 1, 1)
END = dt.datetime(9999, 12, 31)


def at(n):
    return None if n is None else T0 + dt.timedelta(minutes=n)


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# --- intervals -----------------------------------------------------------------------
def brute_merge(rows, gap=0):
    by_key = defaultdict(list)
    for key, a, b in rows:
        if key is not None and a is not None and (b is None or a <= b):
            by_key[key].append((at(a), END if b is None else at(b)))
    out = []
    for key, spans in by_key.items():
        merged = []
        for a, b in sorted(spans):
            if merged and (merged[-1][1] == END or a <= merged[-1][1] + dt.timedelta(minutes=gap)):
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]), merged[-1][2] + 1)
            else:
                merged.append((a, b, 1))
        out += [(key, *m) for m in merged]
    return sorted(out, key=str)


def spans_df(spark, rows):
    return spark.createDataFrame([(k, at(a), at(b)) for k, a, b in rows], "k string, a timestamp, b timestamp").repartition(5)


@pytest.mark.parametrize("gap, partitions", [(0, 3), (5, 3), (0, 50), (7, 1)])
def test_merged_intervals(spark, gap, partitions):
    r = random.Random(gap)
    rows = [("touch", 0, 5), ("touch", 5, 9), ("touch", 9, 9), ("apart", 0, 5), ("apart", 6, 7), ("inside", 0, 100), ("inside", 10, 20),
            ("inside", 101, 102), ("open", 3, None), ("open", 900, 901), (None, 1, 2), ("x", None, 4), ("back", 9, 3),
            ("same", 1, 2), ("same", 1, 2), ("same", 1, 2)]
    # one key with most of the rows: it spans tasks
    rows += [("hot", a, a + r.randint(0, 6)) for a in (r.randint(0, 4000) for _ in range(600))]
    got = intervals.merge_intervals(spans_df(spark, rows), ["k"], "a", "b", f"{gap} MINUTES" if gap else None,
                                    num_partitions=partitions)
    assert rows_of(got, ["k", "a", "b", "n_merged"]) == brute_merge(rows, gap)


def test_intersections(spark):
    a, b = [("k", 0, 10), ("k", 20, 30), ("l", 0, None)], [("k", 5, 25), ("k", 30, 40), ("l", 7, 9), ("m", 0, 1)]
    got = intervals.intersect_intervals(spans_df(spark, a), spans_df(spark, b), ["k"], "a", "b")
    assert rows_of(got, ["k", "a", "b"]) == sorted([("k", at(5), at(10)), ("k", at(20), at(25)), ("l", at(7), at(9))], key=str)


def test_empty_licences_and_touching_borders(spark):
    g = GoldBuild(spark, SF)
    f = g.fact.limit(1).collect()[0]
    region = g.dim_user.filter(F.col("user_sk") == f.user_sk).first().region
    day = dt.timedelta(days=1)
    for a, b, inside in ((f.rated_at, f.rated_at + day, True), (f.rated_at - day, f.rated_at, False), (f.rated_at, f.rated_at, False)):
        lic = spark.createDataFrame([(f.content_sk, region, a, b)],
                                    "content_sk string, region string, available_from timestamp, available_to timestamp")
        got = intervals.with_availability(g.fact, g.dim_user, intervals.availability_windows(lic)).filter(F.col("rating_sk") == f.rating_sk)
        assert [r.was_available for r in got.collect()] == [inside] * got.count()


# --- bitemporal ------------------------------------------------------------------------
def brute_versions(obs):
    """C2 over observations (capture, recorded, value) of one key; of one capture the last recorded counts."""
    latest = {}
    for t, r, v in sorted(obs, key=lambda o: (o[1], o[0], o[2] is not None, o[2] or "")):
        latest[t] = v
    out, was = [], object()
    for t in sorted(latest):
        if latest[t] != was:
            out.append([latest[t], t, None])
            if len(out) > 1:
                out[-2][2] = t
            was = latest[t]
    return sorted((tuple(x) for x in out), key=str)


def test_bitemporal_equals_every_known_history(spark):
    r = random.Random(4)
    obs = {k: [(r.randint(0, 9), r.randint(0, 12), r.choice(["a", "b", None])) for _ in range(r.randint(1, 9))] for k in map(str, range(40))}
    obs["late"] = [(1, 1, "a"), (5, 5, "b"), (3, 7, "c"), (4, 8, "b"), (0, 9, "a"), (5, 10, "a")]
    data = [(k, at(t), at(rec), v) for k, o in obs.items() for t, rec, v in o] + [(None, at(1), at(1), "x"), ("z", None, at(1), "x")]
    df = spark.createDataFrame(data, "user_id string, capture_ts timestamp, recorded_ts timestamp, tier string").repartition(4)
    got = bitemporal.bitemporal_history(df, check_cols=["tier"]).cache()
    for day in range(14):
        known = defaultdict(list)
        for row in bitemporal.as_known(got, str(at(day))).collect():
            known[row.user_id].append((row.tier, row.valid_from, row.valid_to))
        want = {k: brute_versions([(at(t), rec, v) for t, rec, v in o if rec <= day]) for k, o in obs.items()}
        assert {k: sorted(v, key=str) for k, v in known.items()} == {k: v for k, v in want.items() if v}
    # beliefs of one version follow each other and rows do not grow with deliveries times observations
    assert got.filter("recorded_from >= recorded_to").isEmpty()
    assert got.count() <= 3 * sum(map(len, obs.values()))
    moved = bitemporal.restated(got.filter("user_id = 'late'"), str(at(6)), str(at(7)))
    assert rows_of(moved, ["tier", "valid_from", "valid_to"]) == [("a", at(1), at(5))]


def test_bitemporal_of_nothing(spark):
    df = spark.createDataFrame([], "user_id string, capture_ts timestamp, recorded_ts timestamp, tier string")
    assert bitemporal.bitemporal_history(df, check_cols=["tier"]).isEmpty()


# --- grains ------------------------------------------------------------------------------
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cube_expands_cells_not_the_fact(spark):
    g = GoldBuild(spark, SF)
    plan = _plan(rollups.rating_cube(g.fact, g.dim_content))
    assert plan.count("Expand") == 1 and "CartesianProduct" not in plan
    # below the Expand: the cells' aggregate, below that the titles' one
    below = plan[plan.index("Expand"):]
    assert below.index("HashAggregate(keys=[era") < below.index("HashAggregate(keys=[content_sk")
    total = rollups.rating_cube(g.fact, g.dim_content).filter("grain = 15").first()
    assert total.n_ratings == g.fact.count() and total.era is None


def test_stored_sketches_merge_within_bounds(spark, tmp_dir):
    users, titles = 30_000, 12
    fact = spark.range(users * 4).select(
        (F.col("id") % users).cast("string").alias("user_sk"), (F.xxhash64("id") % titles).cast("string").alias("content_sk"),
        F.lit(2000).alias("rating_year"), (F.pmod("id", F.lit(12)) + 1).cast("int").alias("rating_month"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000)).cast("int").alias("days_since_release"))
    dim_user = spark.range(users).select(F.col("id").cast("string").alias("user_sk"), F.col("id").cast("string").alias("user_id"))
    sinks.write_gold(rollups.viewer_sketches(fact, dim_user), tmp_dir + "/sketches")
    stored = spark.read.parquet(tmp_dir + "/sketches")
    got = rollups.sketch_estimates(rollups.merged_sketches(stored, ["rating_year"])).first()
    assert got.n_ratings == 4 * users and abs(got.n_viewers - users) <= rollups.DISTINCT_ERROR * users
    rank = fact.filter(F.col("days_since_release") <= got.median_age).count() / (4 * users)
    assert abs(rank - 0.5) <= rollups.RANK_ERROR


def test_rolling_means_count_calendar_days(spark):
    days = [(0, 4.0), (6, 2.0), (7, 1.0), (29, 5.0), (30, 5.0), (200, 3.0)]
    fact = spark.createDataFrame([("t", T0 + dt.timedelta(days=d, hours=23), v) for d, v in days], "content_sk string, rated_at timestamp, rating_value double")
    got = {(r.day - T0.date()).days: r for r in rollups.rolling_means(rollups.title_days(fact)).collect()}
    for d, _ in days:
        for span in rollups.ROLLING_DAYS:
            values = [v for x, v in days if d - span < x <= d]
            assert got[d][f"n_{span}d"] == len(values) and math.isclose(got[d][f"mean_{span}d"], sum(values) / len(values))


# --- sessions -------------------------------------------------------------------------------
def test_sessions_in_any_order_of_files(spark, tmp_dir):
    r = random.Random(8)
    events = [(u, r.randint(0, 3000)) for u in range(5) for _ in range(40)] + [(9, 0), (9, 30), (9, 61), (9, 61), (None, 5), (3, None)]
    r.shuffle(events)
    schema = "user_id long, ts timestamp"
    for i in range(4):
        spark.createDataFrame([(u, at(t)) for u, t in events[i::4]], schema).coalesce(1).write.parquet(f"{tmp_dir}/in/part={i}")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(tmp_dir + "/in"))
    got = sessions.run_sessions(stream, tmp_dir + "/out", tmp_dir + "/ckpt", 1800)
    want = []
    for u in {u for u, _ in events if u is not None}:
        for t in sorted(t for v, t in events if v == u and t is not None):
            if want and want[-1][0] == u and t - want[-1][2] <= 30:
                want[-1] = (u, want[-1][1], t, want[-1][3] + 1)
            else:
                want.append((u, t, t, 1))
    assert rows_of(got, ["user_id", "session_start", "session_end", "n_events"]) == sorted(
        [(u, at(a), at(b), n) for u, a, b, n in want], key=str)


def test_too_late_events_are_returned_by_the_stateful_form(spark, tmp_dir):
    schema = "user_id long, ts timestamp"
    for i, part in enumerate(([(1, 0), (1, 5)], [(1, 6000), (2, 6000)], [(2, 12_000)], [(1, 10)], [(2, 20_000)], [(2, 30_000)])):
        spark.createDataFrame([(u, at(t)) for u, t in part], schema).coalesce(1).write.parquet(f"{tmp_dir}/in/part={i}")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(tmp_dir + "/in"))
    ratings_stream.run_available_now(sessions.session_window_stream(stream, 600, "1 hour"), tmp_dir + "/o", tmp_dir + "/c")
    closed = spark.read.parquet(tmp_dir + "/o")
    late = sessions.outside_sessions(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(tmp_dir + "/in"), closed)
    assert (1, at(10)) in {tuple(r) for r in late.collect()}
    assert (1, at(0), at(5), 2) in {tuple(r) for r in closed.collect()}


# --- set operations ------------------------------------------------------------------------------
def test_division_by_brute_force(spark):
    r = random.Random(2)
    titles = [(str(t), "g%d" % (t % 4), "classic" if t % 2 else "recent") for t in range(14)]
    rated = {(u, t) for u in range(20) for t in range(14) if r.random() < 0.7}
    fact = spark.createDataFrame([(str(t), f"{u}-{v}") for u, t in rated for v in range(r.randint(1, 2))], "content_sk string, user_sk string")
    dim_user = spark.createDataFrame([(f"{u}-{v}", str(u)) for u in range(20) for v in range(2)], "user_sk string, user_id string")
    content = spark.createDataFrame(titles, "content_sk string, primary_genre string, era string")
    got = rows_of(comparison.complete_raters(fact, dim_user, content), ["user_id", "primary_genre", "era", "n_titles"])
    groups = defaultdict(set)
    for t, genre, era in titles:
        groups[genre, era].add(int(t))
    want = [(str(u), *g, len(ts)) for g, ts in groups.items() for u in range(20) if len(ts) >= 2 and all((u, t) in rated for t in ts)]
    assert got == sorted(want, key=str) and got


def test_difference_of_runs(spark):
    schema = "k int, a string, b int, stamp int"
    before = spark.createDataFrame([(1, "x", 1, 0), (2, "x", None, 0), (3, "x", 1, 0), (4, "dup", 1, 0), (4, "dup", 1, 0), (None, "n", 1, 0)], schema)
    after = spark.createDataFrame([(1, "x", 1, 9), (2, "x", 2, 9), (5, None, 1, 9), (4, "dup", 1, 9), (None, "m", 2, 9)], schema)
    got = rows_of(comparison.run_difference(before, after, ["k"], ignore=["stamp"]), ["k", "change", "n", "changed_columns"])
    assert got == sorted([(2, "changed", 1, ["b"]), (3, "removed", 1, []), (4, "removed", 1, []), (5, "added", 1, []),
                          (None, "changed", 1, ["a", "b"])], key=str)
    assert comparison.run_difference(after, after, ["k"]).isEmpty()


# --- corrections (I2) and the rating stream (I1) -----------------------------------------------------
def multiset(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture()
def dims(spark):
    g = GoldBuild(spark, SF)
    was_content, _ = _runs(g)
    lost = (F.pmod(F.xxhash64("user_id"), F.lit(3)) == 0) & (F.col("capture_ts") == F.lit(g.capture_dates[1]).cast("timestamp"))
    return g, was_content, history.dim_user(history.scd2_from_captures(g.stg_user_captures.filter(~lost)))


def test_corrected_dimensions_add_no_event(spark, tmp_dir, dims):
    g, was_content, was_user = dims
    was_content = was_content.unionByName(g.dim_content.drop("updated_at").join(was_content, "content_sk", "left_anti"))
    path, columns = tmp_dir + "/fact", g.fact.columns
    sinks.write_gold(facts.fact_viewership(g.stg_ratings, was_content, was_user), path, "rating_year")
    old = multiset(spark.read.parquet(path), columns)
    first = incremental.incremental_fact(spark, path, g.stg_ratings, g.dim_content, g.dim_user)
    assert first["rows"] == 0 and first["changed"] > 0
    assert multiset(spark.read.parquet(path), columns) == multiset(g.fact, columns) != old
    again = incremental.incremental_fact(spark, path, g.stg_ratings, g.dim_content, g.dim_user)
    assert (again["rows"], again["changed"]) == (0, 0)


def test_correction_without_the_source(spark, tmp_dir, dims):
    g, was_content, was_user = dims
    path, columns = tmp_dir + "/fact", g.fact.columns
    sinks.write_gold(facts.fact_viewership(g.stg_ratings, was_content, was_user), path, "rating_year")
    known = g.dim_content.join(was_content, "content_sk", "left_semi")
    got = incremental.correct_fact(spark, path, was_content, known, was_user, g.dim_user)
    assert got["changed"] > 0
    assert multiset(spark.read.parquet(path), columns) == multiset(facts.fact_viewership(g.stg_ratings, known, g.dim_user), columns)
    assert incremental.correct_fact(spark, path, known, known, g.dim_user, g.dim_user) == {"years": [], "changed": 0}
    # titles that no longer exist take their rows along, whole years of them too
    gone = incremental.correct_fact(spark, path, known, known.limit(0), g.dim_user, g.dim_user)
    assert gone["changed"] == 0 and spark.read.schema(g.fact.schema).parquet(path).isEmpty()


def test_duplicates_of_an_event_count(spark, tmp_dir):
    g = GoldBuild(spark, SF)
    path, columns = tmp_dir + "/fact", g.fact.columns
    twice = g.stg_ratings.unionByName(g.stg_ratings.limit(50))
    sinks.write_gold(g.fact, path, "rating_year")
    full = facts.fact_viewership(twice, g.dim_content, g.dim_user)
    for _ in range(2):
        incremental.incremental_fact(spark, path, twice, g.dim_content, g.dim_user)
        assert multiset(spark.read.parquet(path), columns) == multiset(full, columns)


def test_stream_reads_only_touched_months(spark, tmp_dir):
    months = [dt.date(2000, m, 1) for m in range(1, 7)]
    rows = [("u", "m", dt.datetime(2000, m, 3), 1.0, months[m - 1]) for m in range(1, 7)]
    batch = spark.createDataFrame(rows, "user_id string, movie_id string, rated_at timestamp, rating_value double, rated_month date")
    sinks.write_gold(batch, f"{tmp_dir}/batch=0", "rated_month")
    held = ratings_stream.held_before(spark, tmp_dir, batch.schema, 1, ratings_stream.batch_months(batch.limit(2)))
    plan = _plan(held)
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "rated_month" in filters and "batch" in filters and "PushedFilters: []" in plan
    assert held.count() == 2 and len(held.inputFiles()) == 6
    scanned = held.select("_metadata.file_path").distinct().count()
    assert scanned == 2


def test_fixture_of_late_captures_is_out_of_order(spark):
    caps = fixtures.with_recording(GoldBuild(spark, SF).stg_user_captures)
    late = caps.groupBy("user_id").agg(F.max_by("capture_ts", "recorded_ts").alias("last"), F.max("capture_ts").alias("newest"))
    assert late.filter("last < newest").count() > 0


# --- joins and tasks at size ------------------------------------------------------------
def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def windows_case(spark):
    fact = spark.createDataFrame([("t1", "v1", at(5)), ("t1", "v2", at(15)), ("t2", "v1", at(5))],
                                 "content_sk string, user_sk string, rated_at timestamp")
    users = spark.createDataFrame([("v1", "u", "NA", at(0), at(10)), ("v2", "u", "EU", at(10), END)],
                                  "user_sk string, user_id string, region string, valid_from timestamp, valid_to timestamp")
    windows = spark.sql(f"""SELECT * FROM VALUES ('t1', 'NA', TIMESTAMP '{at(3)}', TIMESTAMP '{at(8)}'), ('t1', 'EU', TIMESTAMP '{at(20)}', TIMESTAMP '{END}')
                            AS w (content_sk, region, available_from, available_to)""")
    return fact, users, windows


def test_windows_are_not_broadcast(spark):
    """However small Spark takes them for, merged windows meet the fact in a merge join."""
    fact, users, windows = windows_case(spark)
    flagged, exposed = intervals.with_availability(fact, users, windows), intervals.audience_exposure(fact, users, windows)
    for df, keys in ((flagged, "_title"), (exposed, "content_sk")):
        joins = [x for x in plan_of(df)[1].splitlines() if "Join [content_sk" in x and keys in x]
        assert joins and all("SortMergeJoin" in x for x in joins), joins
    assert rows_of(flagged, ["content_sk", "user_sk", "was_available"]) == [("t1", "v1", True), ("t1", "v2", False), ("t2", "v1", False)]
    assert rows_of(exposed, ["content_sk", "region", "valid_from", "valid_to"]) == sorted(
        [("t1", "NA", at(3), at(8)), ("t1", "EU", at(20), END)], key=str)


def test_licences_are_drawn_in_many_tasks(spark, tmp_dir):
    spark.range(200).withColumnRenamed("id", "p_partkey").coalesce(1).write.parquet(f"{tmp_dir}/part.parquet")
    licences = fixtures.fx_licences(spark, tmp_dir)
    assert licences.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert licences.select("movie_id").distinct().count() > 190


def test_users_meet_the_ratings_before_titles(spark):
    ratings = spark.createDataFrame([("u", "m", 1.0, at(0), True)],
                                    "user_id string, movie_id string, rating_value double, rated_at timestamp, is_positive boolean")
    content = spark.createDataFrame([("t", "m", 1990)], "content_sk string, movie_id string, release_year int")
    users = spark.createDataFrame([("v", "u", "basic", at(0), END)],
                                  "user_sk string, user_id string, membership_tier string, valid_from timestamp, valid_to timestamp")
    fact = facts.fact_viewership(ratings, content, users)
    joins = [x for x in plan_of(fact)[0].splitlines() if "Join Inner" in x]
    assert len(joins) == 2 and "movie_id" in joins[0] and "_uid" in joins[1]
    assert rows_of(fact, ["user_sk", "content_sk"]) == [("v", "t")]


def test_latest_rating_moves_each_column_once(spark):
    rows = [("u", "t", at(1), "a", 2.0, "x"), ("u", "t", at(2), "a", 1.0, "y"), ("u", "t", at(2), "b", 1.0, "z"), ("u", "t", at(2), "b", 3.0, None),
            ("u", None, None, "a", 1.0, "x")]
    fact = spark.createDataFrame(rows, "user_id string, content_sk string, rated_at timestamp, rating_sk string, rating_value double, tier string")
    latest = facts.latest_rating(fact.select("tier", *fact.columns[:-1]))
    assert latest.columns == ["user_id", "content_sk", "tier", "rated_at", "rating_sk", "rating_value"]
    assert rows_of(latest, fact.columns) == sorted([rows[3], rows[4]], key=str)
    assert "max_by" not in plan_of(latest)[0]


def test_late_deliveries_keep_their_tasks(spark, tmp_dir):
    """A delivery is written by as many tasks as it has, and read as one batch."""
    import glob
    from reelhouse.plans import registry
    from reelhouse.session import checkpoint_root
    n = F.col("id")
    spark.range(400).select((n / 4).cast("long").alias("l_orderkey"), (n % 30).alias("l_partkey"), (n % 50 + 1).cast("double").alias("l_quantity"),
                            F.timestamp_seconds(n * 90000 + 800000000).cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.range(100).select(n.alias("o_orderkey"), (n % 17).alias("o_custkey")).write.parquet(f"{tmp_dir}/orders.parquet")
    there = set(glob.glob(f"{checkpoint_root(spark)}/**/stream-late-*".replace("file://", ""), recursive=True))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        got = registry.queries()["stream_ratings_late"](spark, tmp_dir)
    finally:
        spark.conf.set(coalesce, old)
    root, = set(glob.glob(f"{checkpoint_root(spark)}/**/stream-late-*".replace("file://", ""), recursive=True)) - there
    assert len(glob.glob(f"{root}/in/delivery=0/*.parquet")) > 1
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{root}/out/batch=*")) == ["0", "1", "2"]
    want = GoldBuild(spark, tmp_dir).stg_ratings
    assert rows_of(got, ["user_id", "movie_id", "rating_value"]) == rows_of(want, ["user_id", "movie_id", "rating_value"])
