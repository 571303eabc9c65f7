"""Registered queries: availability, bitemporal history, grains, sessions, set operations, corrections.

Imported by ``plans.registry``, which holds the registry itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.keys import surrogate_key
from reelhouse.operators import bitemporal, comparison, drift, facts, history, intervals, rollups
from reelhouse.plans import oracle as O
from reelhouse.plans.gold import GoldBuild
from reelhouse.plans.registry import register, staged_csv, staged_tables, staging_dir
from reelhouse.sources import files, fixtures, records, semistructured, sinks
from reelhouse.streaming import incremental, interval_join, ratings_stream, sessions

# Fixed values.
KNOWN_AT = "1999-06-01 00:00:00"
SESSION_GAP = 7200


# --- availability (I6) ---------------------------------------------------------------------------
def _hex(h: str, first: int, n: int) -> str:
    return f"CAST(('0x' || substr({h}, {first}, {n})) AS INTEGER)"


def _start(h: str) -> str:
    return f"(DATE '{fixtures.LICENCE_EPOCH}' + {_hex(h, 2, 3)} % 2600)"


def _end(h: str) -> str:
    return f"({_start(h)} + {_hex(h, 5, 3)} % 700 + 1)"


O.cte("fx_licences", (), f"""
  SELECT movie_id, region, slot, CAST(if(slot = 3, {_end('prior')}, {_start('h')}) AS TIMESTAMP) AS available_from,
         CASE WHEN {_hex('h', 8, 1)} > 0
              THEN CAST(if(slot = 3, {_end('prior')} + {_hex('h', 5, 3)} % 700 + 1, {_end('h')}) AS TIMESTAMP) END AS available_to
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS movie_id, region, slot, md5(concat_ws('-', p_partkey, region, slot)) AS h,
               md5(concat_ws('-', p_partkey, region, slot - 1)) AS prior
        FROM part, (VALUES ('NA'), ('EU'), ('APAC'), ('LATAM')) r(region), range(4) s(slot)) x
  WHERE {_hex('h', 1, 1)} < 10""")

O.cte("availability", ("fx_licences",), f"""
  SELECT content_sk, region, min(t0) AS available_from, max(t1) AS available_to, count(*) AS n_licences
  FROM (SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY content_sk, region ORDER BY t0, t1, slot) AS island
        FROM (SELECT *, coalesce(t0 > max(t1) OVER (PARTITION BY content_sk, region ORDER BY t0, t1, slot
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh
              FROM (SELECT {O.sk('movie_id')} AS content_sk, region, slot, available_from AS t0,
                           coalesce(available_to, TIMESTAMP '9999-12-31 00:00:00') AS t1 FROM fx_licences) l) m) n
  GROUP BY content_sk, region, island""")


def _windows(g: GoldBuild) -> DataFrame:
    licences = fixtures.fx_licences(g.spark, g.sf_dir).withColumn("content_sk", surrogate_key("movie_id"))
    return intervals.availability_windows(licences)


@register("availability_windows", O.sql_with("SELECT * FROM availability", "availability"))
def _availability(g: GoldBuild) -> DataFrame:
    """Licences of every title and region, overlapping, touching and open ones merged."""
    return _windows(g)


@register("availability_fact", O.sql_with("""
SELECT f.*, u.region, a.available_from, a.available_to, a.available_from IS NOT NULL AS was_available
FROM fact f JOIN dim_user u ON u.user_sk = f.user_sk
LEFT JOIN availability a ON a.content_sk = f.content_sk AND a.region = u.region
     AND f.rated_at >= a.available_from AND f.rated_at < a.available_to""", "fact", "dim_user", "availability"))
def _availability_fact(g: GoldBuild) -> DataFrame:
    """Every fact row flagged inside or outside a window of its user's region."""
    return intervals.with_availability(g.fact, g.dim_user, _windows(g))


@register("audience_exposure", O.sql_with("""
SELECT p.user_id, p.content_sk, u.region, greatest(u.valid_from, a.available_from) AS valid_from,
       least(u.valid_to, a.available_to) AS valid_to
FROM (SELECT DISTINCT u.user_id, f.content_sk FROM fact f JOIN dim_user u ON u.user_sk = f.user_sk) p
JOIN dim_user u ON u.user_id = p.user_id
JOIN availability a ON a.content_sk = p.content_sk AND a.region = u.region
 AND a.available_from < u.valid_to AND u.valid_from < a.available_to""", "fact", "dim_user", "availability"))
def _exposure(g: GoldBuild) -> DataFrame:
    """User versions intersected with the windows of the titles they rated."""
    return intervals.audience_exposure(g.fact, g.dim_user, _windows(g))


# --- late captures (C1, C2) -------------------------------------------------------------------------
O.cte("deliveries", ("stg_user_captures",), """
  SELECT *, if(substr(md5(concat_ws('-', user_id, strftime(capture_ts, '%Y-%m-%d'))), 1, 1) < '4',
               capture_ts + INTERVAL 1095 DAY, capture_ts) AS recorded_ts
  FROM stg_user_captures""")


def _known_versions(days: str) -> str:
    """Versions as known on each day of ``days`` (day, n): the history over what was recorded by then."""
    return f"""
  SELECT day, n, user_id, membership_tier, region, device_preference, capture_ts AS valid_from,
         lead(capture_ts) OVER (PARTITION BY day, user_id ORDER BY capture_ts) AS valid_to
  FROM (SELECT d.day, d.n, c.*, row_number() OVER w AS k, lag((membership_tier, region, device_preference)) OVER w AS was
        FROM {days} d JOIN deliveries c ON c.recorded_ts <= d.day WINDOW w AS (PARTITION BY d.day, user_id ORDER BY capture_ts)) x
  WHERE k = 1 OR was IS DISTINCT FROM (membership_tier, region, device_preference)"""


O.cte("delivery_days", ("deliveries",), """
  SELECT recorded_ts AS day, row_number() OVER (ORDER BY recorded_ts) AS n FROM (SELECT DISTINCT recorded_ts FROM deliveries) d""")
O.cte("known", ("deliveries", "delivery_days"), _known_versions("delivery_days"))


@register("bitemporal_history", O.sql_with("""
SELECT user_id, membership_tier, region, device_preference, valid_from, valid_to, min(day) AS recorded_from,
       (SELECT min(day) FROM delivery_days WHERE delivery_days.n > max(r.n)) AS recorded_to
FROM (SELECT *, n - row_number() OVER (PARTITION BY user_id, membership_tier, region, device_preference, valid_from, valid_to
                                       ORDER BY n) AS run FROM known) r
GROUP BY user_id, membership_tier, region, device_preference, valid_from, valid_to, run""", "known"))
def _bitemporal(g: GoldBuild) -> DataFrame:
    """C2 with late captures: what was true when, and when it was known; deliveries in shuffled order."""
    return bitemporal.bitemporal_history(fixtures.with_recording(g.stg_user_captures).orderBy(F.xxhash64("user_id", "capture_ts")))


@register("history_as_known", O.sql_with(f"""
SELECT user_id, membership_tier, region, device_preference, valid_from, valid_to
FROM ({_known_versions(f"(SELECT TIMESTAMP '{KNOWN_AT}' AS day, 1 AS n)")}) v""", "deliveries"))
def _as_known(g: GoldBuild) -> DataFrame:
    """The user history as it was known on one day."""
    return bitemporal.as_known(bitemporal.bitemporal_history(fixtures.with_recording(g.stg_user_captures)), KNOWN_AT)


# --- grains -----------------------------------------------------------------------------------------
@register("rating_cube", O.sql_with("""
SELECT c.era, c.primary_genre, f.membership_tier_at_rating AS membership_tier, f.rating_year,
       CAST(grouping_id(c.era, c.primary_genre, f.membership_tier_at_rating, f.rating_year) AS BIGINT) AS grain,
       count(*) AS n_ratings, sum(f.rating_value)::DOUBLE / count(*) AS avg_rating,
       count(*) FILTER (f.is_positive) AS n_positive
FROM fact f JOIN dim_content c ON c.content_sk = f.content_sk
GROUP BY CUBE (c.era, c.primary_genre, f.membership_tier_at_rating, f.rating_year)""", "fact", "dim_content"))
def _cube(g: GoldBuild) -> DataFrame:
    return rollups.rating_cube(g.fact, g.dim_content)


def _frame(span: int) -> str:
    w = f"OVER (PARTITION BY content_sk ORDER BY day RANGE BETWEEN INTERVAL {span - 1} DAYS PRECEDING AND CURRENT ROW)"
    return (f"CAST(sum(n_ratings) {w} AS BIGINT) AS n_{span}d, "
            f"(sum(s10) {w})::DOUBLE / ((sum(n_ratings) {w}) * 10)::DOUBLE AS mean_{span}d")


@register("rolling_means", O.sql_with(f"""
SELECT content_sk, day, n_ratings, {', '.join(map(_frame, rollups.ROLLING_DAYS))}
FROM (SELECT content_sk, CAST(rated_at AS DATE) AS day, count(*) AS n_ratings, sum(CAST(rating_value * 10 AS BIGINT)) AS s10
      FROM fact GROUP BY content_sk, CAST(rated_at AS DATE)) d""", "fact"))
def _rolling(g: GoldBuild) -> DataFrame:
    return rollups.rolling_means(rollups.title_days(g.fact))


@register("sketch_check", O.sql_with("""
SELECT c.primary_genre, f.rating_year, count(*) AS n_ratings, count(DISTINCT u.user_id) AS n_viewers,
       true AS viewers_within, true AS median_within
FROM fact f JOIN dim_content c ON c.content_sk = f.content_sk JOIN dim_user u ON u.user_sk = f.user_sk
GROUP BY c.primary_genre, f.rating_year""", "fact", "dim_content", "dim_user"))
def _sketches(g: GoldBuild) -> DataFrame:
    """Monthly title sketches merged to (genre, year); estimates held against exact figures and their bounds."""
    return rollups.sketch_check(g.fact, g.dim_user, g.dim_content)


# --- sessions ------------------------------------------------------------------------------------------
@register("stream_sessions", f"""
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events
FROM (SELECT user_id, ts, sum(fresh::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
      FROM (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL {SESSION_GAP} SECOND, true) AS fresh
            FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL) e) s
GROUP BY user_id, k""")
def _sessions(g: GoldBuild) -> DataFrame:
    """Viewer sessions of the event stream; the events arrive in four files, each with events of the whole month."""
    root = staging_dir(g, "sessions")
    events = g.spark.read.parquet(f"{g.sf_dir}/events.parquet")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    events.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(f"{root}/in")
    stream = (g.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true")
              .parquet(f"{root}/in"))
    return sessions.run_sessions(stream, f"{root}/out", f"{root}/ckpt", SESSION_GAP)


# --- set operations ----------------------------------------------------------------------------------------
O.cte("rated", ("fact", "dim_user", "dim_content"), """
  SELECT DISTINCT u.user_id, f.content_sk FROM fact f JOIN dim_user u ON u.user_sk = f.user_sk""")


@register("complete_raters", O.sql_with("""
SELECT u.user_id, g.release_year, g.primary_genre, g.n_titles
FROM (SELECT DISTINCT user_id FROM rated) u,
     (SELECT release_year, primary_genre, count(*) AS n_titles FROM dim_content GROUP BY ALL HAVING count(*) >= 2) g
WHERE NOT EXISTS (SELECT 1 FROM dim_content c
                  WHERE c.release_year = g.release_year AND c.primary_genre = g.primary_genre
                    AND NOT EXISTS (SELECT 1 FROM rated r WHERE r.user_id = u.user_id AND r.content_sk = c.content_sk))""", "rated"))
def _complete(g: GoldBuild) -> DataFrame:
    """Relational division: users who rated every title of a (release year, genre) that has two or more."""
    return comparison.complete_raters(g.fact, g.dim_user, g.dim_content, ("release_year", "primary_genre"))


def _runs(g: GoldBuild) -> tuple[DataFrame, DataFrame]:
    """The titles of two runs: the earlier one lacks some, and has other years and spellings."""
    now, n = g.dim_content.drop("updated_at"), F.col("movie_id").cast("long")
    was = now.filter(n % 20 != 1).withColumns({
        "release_year": F.when(n % 10 == 0, F.col("release_year") - 3).otherwise(F.col("release_year")),
        "title": F.when(n % 30 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title"))})
    return was, now.filter(n % 20 != 2)


@register("gold_difference", O.sql_with("""
SELECT content_sk, CASE WHEN b.content_sk IS NULL THEN 'added' WHEN a.content_sk IS NULL THEN 'removed' ELSE 'changed' END AS change,
       CAST(1 AS BIGINT) AS n,
       CASE WHEN a.content_sk IS NULL OR b.content_sk IS NULL THEN CAST([] AS VARCHAR[])
            ELSE list_concat(if(b.title IS DISTINCT FROM a.title, ['title'], []),
                             if(b.release_year IS DISTINCT FROM a.release_year, ['release_year'], [])) END AS changed_columns
FROM (SELECT * FROM dim_content WHERE CAST(movie_id AS BIGINT) % 20 <> 2) a
FULL JOIN (SELECT content_sk, movie_id, if(CAST(movie_id AS BIGINT) % 30 = 0, title || '!', title) AS title,
                  if(CAST(movie_id AS BIGINT) % 10 = 0, release_year - 3, release_year) AS release_year
           FROM dim_content WHERE CAST(movie_id AS BIGINT) % 20 <> 1) b USING (content_sk)
WHERE a.content_sk IS NULL OR b.content_sk IS NULL OR a.title <> b.title OR a.release_year <> b.release_year""", "dim_content"))
def _difference(g: GoldBuild) -> DataFrame:
    was, now = _runs(g)
    return comparison.run_difference(was, now, ["content_sk"])


# --- corrections (I2) ------------------------------------------------------------------------------------
@register("incremental_fact_corrected", O.sql_with("SELECT * FROM fact", "fact"))
def _corrected(g: GoldBuild) -> DataFrame:
    """I2 after corrections: the fact before 1999 was built with wrong release years of a tenth of the titles
    and without one capture of a third of the users; then both are corrected, and the whole source is loaded twice."""
    path = staging_dir(g, "incremental-corrected")
    was_content, _ = _runs(g)
    lost = (F.pmod(F.xxhash64("user_id"), F.lit(3)) == 0) & (F.col("capture_ts") == F.lit(g.capture_dates[1]).cast("timestamp"))
    was_user = history.dim_user(history.scd2_from_captures(g.stg_user_captures.filter(~lost)))
    ratings, was_content, content, was_user, user = staged_tables(
        g, "incremental-corrected", g.stg_ratings, was_content, g.dim_content, was_user, g.dim_user)
    early = ratings.filter(F.col("rated_at") < F.lit("1999-01-01").cast("timestamp"))
    sinks.write_gold(facts.fact_viewership(early, was_content, was_user), path, "rating_year")
    incremental.correct_fact(g.spark, path, was_content, content, was_user, user)
    for _ in range(2):
        incremental.incremental_fact(g.spark, path, ratings, content, user)
    return g.spark.read.parquet(path).select(*g.fact.columns)


@register("hourly_pipeline", O.sql_with("SELECT * FROM fact", "fact"))
def _hourly(g: GoldBuild) -> DataFrame:
    """L2 by increments: three deliveries of ratings in no order of time, each repeating a third of the last; titles
    come first with wrong years (a tenth) or not at all (a ninth), users with a new capture each.  Returns the fact."""
    from reelhouse.plans import pipeline
    root, out = staging_dir(g, "hourly-deliveries"), staging_dir(g, "hourly")
    files.write_csv(g.raw_tags, f"{root}/tags")
    key = F.pmod(F.xxhash64("title"), F.lit(90))
    wrong = F.when(key < 9, F.regexp_replace("title", r"\(\d{4}\)", "(1931)")).otherwise(F.col("title"))
    files.write_csv(g.raw_movies.filter(key < 80).withColumn("title", wrong), f"{root}/movies-0")
    files.write_csv(g.raw_movies, f"{root}/movies-1")
    names = g.raw_ratings.columns
    lot = F.pmod(F.xxhash64(*names), F.lit(9))
    for i, day in enumerate(g.capture_dates):
        files.write_csv(g.raw_ratings.filter(lot.between(3 * i - 1, 3 * i + 2)), f"{root}/ratings-{i}")
        users = g.raw_user_captures.filter(F.col("capture_ts") == F.lit(day).cast("timestamp")).drop("capture_ts")
        files.write_csv(users, f"{root}/users-{i}")
        src = pipeline.SourceFiles(f"{root}/ratings-{i}", f"{root}/movies-{min(i, 1)}", f"{root}/tags", f"{root}/users-{i}", day)
        pipeline.run_pipeline(g.spark, src, out, run_id=f"hour-{i}", incremental=True)
    return pipeline.current_gold(g.spark, out).read(g.spark, "fact_viewership").select(*g.fact.columns)


# --- two streams, semi-structured fields, drift -------------------------------------------------------------
@register("stream_interval_join", """
SELECT v.user_id, v.event_id AS view_id, v.ts AS viewed_at, p.event_id AS purchase_id, p.ts AS bought_at, p.value
FROM events v JOIN events p ON p.user_id = v.user_id AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 1 DAY
WHERE v.event_type = 'view' AND p.event_type = 'purchase'""")
def _interval_join(g: GoldBuild) -> DataFrame:
    """Purchases within a day after a view by the same user: two streams of the events, four files each that mix
    the whole month, joined under watermarks."""
    root = staging_dir(g, "interval-join")
    events = g.spark.read.parquet(f"{g.sf_dir}/events.parquet")
    events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4))).repartition("part").write.partitionBy("part").parquet(f"{root}/in")

    def stream(kind: str, event_id: str, at: str, *more: str) -> DataFrame:
        raw = (g.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true")
               .parquet(f"{root}/in"))
        return raw.filter(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(event_id), F.col("ts").alias(at), *more)

    joined = interval_join.interval_join(stream("view", "view_id", "viewed_at"), stream("purchase", "purchase_id", "bought_at", "value"),
                                         ["user_id"], "viewed_at", "bought_at", "1 DAY", "40 days")
    ratings_stream.run_available_now(joined, f"{root}/out", f"{root}/ckpt")
    return g.spark.read.parquet(f"{root}/out").select(*joined.columns)


def _changing_props(events: DataFrame) -> DataFrame:
    """Events whose JSON has changed over time: another type, new and nested fields, broken and missing objects."""
    kind = F.col("event_id") % 10
    return events.withColumn("props", F.when(kind == 0, F.lit('{"k": "many", "extra": 1}')).when(kind == 1, F.lit('{"k": 5, "nested": {"a": [1, 2]}}'))
                             .when(kind == 2, F.lit('{"k": ')).when(kind == 3, F.lit(None)).otherwise(F.col("props")))


O.cte("changing_props", (), """
  SELECT * REPLACE (CASE event_id % 10 WHEN 0 THEN '{"k": "many", "extra": 1}' WHEN 1 THEN '{"k": 5, "nested": {"a": [1, 2]}}'
                                       WHEN 2 THEN '{"k": ' WHEN 3 THEN NULL ELSE props END AS props) FROM events""")


@register("event_props", O.sql_with("""
SELECT event_type, count(*) AS n_events, CAST(sum(k) AS BIGINT) AS sum_k, count(*) FILTER (NOT valid) AS n_malformed,
       count(*) FILTER (valid AND (k IS NULL OR props LIKE '%nested%')) AS n_rescued
FROM (SELECT event_type, props, json_valid(props) AS valid,
             CASE WHEN json_valid(props) THEN try_cast(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM changing_props) p
GROUP BY event_type""", "changing_props"))
def _props(g: GoldBuild) -> DataFrame:
    """JSON objects with a declared field and others that come and go: parsed, rescued and marked."""
    events = _changing_props(g.spark.read.parquet(f"{g.sf_dir}/events.parquet"))
    parsed = semistructured.parse_object(events, "props", {"k": "int"})
    return parsed.groupBy("event_type").agg(
        F.count("*").alias("n_events"), F.sum("k").alias("sum_k"), F.count_if(semistructured.MALFORMED).alias("n_malformed"),
        F.count(semistructured.RESCUED).alias("n_rescued"))


def _drift_sql(buckets: int = 20) -> str:
    numbers = ("created_day",)
    other = ("membership_tier", "region", "device_preference")
    cells = [f"""SELECT '{c}' AS "column", CAST(least(floor(({c} - min({c}) OVER ())::DOUBLE * {buckets} / (max({c}) OVER () - min({c}) OVER ())), {buckets - 1}) AS INTEGER) AS at_,
       NULL AS v, side FROM sample""" for c in numbers]
    cells += [f"""SELECT '{c}', NULL, {c}, side FROM sample""" for c in other]
    return f"""
WITH RECURSIVE users AS ({O.sql_with("SELECT * FROM stg_user_captures", "stg_user_captures")}),
sample AS (SELECT if(capture_ts = TIMESTAMP '1996-01-01', 0, 1) AS side, CAST(date_diff('day', DATE '1970-01-01', created_at) AS DOUBLE) AS created_day,
                  membership_tier, region, device_preference FROM users WHERE capture_ts IN (TIMESTAMP '1996-01-01', TIMESTAMP '2000-01-01')),
cell AS ({" UNION ALL ".join(cells)}),
n AS (SELECT "column", at_, v, count(*) FILTER (side = 0) AS b, count(*) FILTER (side = 1) AS a FROM cell GROUP BY ALL),
t AS (SELECT "column", sum(b) AS n_before, sum(a) AS n_after, count(*) AS cells FROM n GROUP BY "column"),
c AS (SELECT n.*, t.n_before, t.n_after, (n.b + 0.5)::DOUBLE / (t.n_before + t.cells * 0.5)::DOUBLE AS p, (n.a + 0.5)::DOUBLE / (t.n_after + t.cells * 0.5)::DOUBLE AS q,
             abs((sum(n.b) OVER w)::DOUBLE / t.n_before::DOUBLE - (sum(n.a) OVER w)::DOUBLE / t.n_after::DOUBLE) AS apart
      FROM n JOIN t ON t."column" = n."column" WINDOW w AS (PARTITION BY n."column" ORDER BY n.at_))
SELECT "column", CAST(n_before AS BIGINT) AS n_before, CAST(n_after AS BIGINT) AS n_after, round(sum((q - p) * ln(q / p)), 9) AS psi,
       round(max(apart) FILTER ("column" = 'created_day'), 9) AS ks, if(sum((q - p) * ln(q / p)) > 0.2, 'fail', 'pass') AS status
FROM c GROUP BY "column", n_before, n_after"""


@register("capture_drift", _drift_sql())
def _drift(g: GoldBuild) -> DataFrame:
    """How the users of the last capture differ from those of the first, column by column."""
    users = g.stg_user_captures.withColumn("created_day", F.unix_date("created_at"))
    first, last = (users.filter(F.col("capture_ts") == F.lit(d).cast("timestamp")) for d in (g.capture_dates[0], g.capture_dates[-1]))
    out = drift.drift(first, last, ["created_day"], ["membership_tier", "region", "device_preference"])
    return out.withColumns({"psi": F.round("psi", 9), "ks": F.round("ks", 9)})


# --- free-text files in splits (A2, A3) -----------------------------------------------------------
@register("scan_movies_split", O.sql_with("SELECT * FROM fx_movies", "fx_movies"))
def _movies_split(g: GoldBuild) -> DataFrame:
    """A2: the titles as CSV, read in splits."""
    return records.scan_records(g.spark, staged_csv(g, "movies-split", g.raw_movies), files.MOVIES_SCHEMA)


@register("scan_tags_split", O.sql_with("""
SELECT "userId", "movieId", concat(tag, chr(10), '"', tag, '", ', chr(13), chr(10), "userId") AS tag, "timestamp"
FROM fx_tags""", "fx_tags"))
def _tags_split(g: GoldBuild) -> DataFrame:
    """A3: tags whose texts hold line breaks, quotes and commas, read in splits."""
    tag = F.concat("tag", F.lit('\n"'), "tag", F.lit('", \r\n'), F.col("userId").cast("string"))
    path = staged_csv(g, "tags-split", g.raw_tags.withColumn("tag", tag))
    return records.scan_records(g.spark, path, files.TAGS_SCHEMA)
