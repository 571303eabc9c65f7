import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import facts, history

COLS = "user_id string, membership_tier string, region string, device_preference string"
CAP_COLS = "capture_ts timestamp, " + COLS


def ts(s):
    return dt.datetime.fromisoformat(s)


def snap_rows(df):
    return sorted(((r.user_id, r.membership_tier, r.region, r.scd_valid_from, r.scd_valid_to)
                   for r in df.collect()), key=str)


def test_capture_cases(spark):
    c1 = spark.createDataFrame([("a", "basic", "NA", "tv"), ("b", "basic", None, "tv"),
                                ("c", "basic", "EU", "tv"), ("d", "premium", "EU", "tv"),
                                ("e", "basic", "EU", "tv")], COLS)
    h1 = history.scd2_capture(None, c1, "2020-01-01").checkpoint()
    c2 = spark.createDataFrame([("a", "premium", "NA", "tv"),   # changed
                                ("b", "basic", "EU", "tv"),     # null -> value
                                ("c", "basic", None, "tv"),     # value -> null
                                ("e", "basic", "EU", "tv"),     # unchanged; d vanished
                                ("f", "basic", "EU", "tv")], COLS)  # new
    h2 = history.scd2_capture(h1, c2, "2021-01-01").checkpoint()
    c3 = spark.createDataFrame([("a", "basic", "NA", "tv"),     # A -> B -> A
                                ("d", "standard", "EU", "tv")], COLS)  # returned, changed
    h3 = history.scd2_capture(h2, c3, "2022-01-01").checkpoint()
    rows = snap_rows(h3)
    t1, t2, t3 = ts("2020-01-01"), ts("2021-01-01"), ts("2022-01-01")
    assert ("a", "basic", "NA", t1, t2) in rows and ("a", "premium", "NA", t2, t3) in rows
    assert ("a", "basic", "NA", t3, None) in rows
    assert ("b", "basic", None, t1, t2) in rows and ("b", "basic", "EU", t2, None) in rows
    assert ("c", "basic", "EU", t1, t2) in rows and ("c", "basic", None, t2, None) in rows
    assert ("d", "premium", "EU", t1, t3) in rows and ("d", "standard", "EU", t3, None) in rows
    assert ("e", "basic", "EU", t1, None) in rows
    assert ("f", "basic", "EU", t2, None) in rows
    assert len(rows) == 11
    # same capture twice: no-op
    assert snap_rows(history.scd2_capture(h3, c3, "2022-01-01")) == rows
    # an older capture is refused
    with pytest.raises(history.SnapshotError):
        history.scd2_capture(h3, c3, "2021-06-01")
    # a duplicate key is refused
    dup = spark.createDataFrame([("a", "basic", "NA", "tv"), ("a", "premium", "NA", "tv")], COLS)
    with pytest.raises(history.SnapshotError):
        history.scd2_capture(h3, dup, "2023-01-01")


def test_fold_equals_bulk(spark):
    import random
    rnd = random.Random(7)
    caps = []
    days = ["2020-01-01", "2020-06-01", "2021-01-01", "2021-06-01"]
    for d in days:
        for u in range(30):
            if rnd.random() < 0.8:
                caps.append((ts(d), f"u{u}", rnd.choice(["basic", "premium", None]),
                             rnd.choice(["NA", "EU"]), "tv"))
    df = spark.createDataFrame(caps, CAP_COLS)
    bulk = history.scd2_from_captures(df)
    h = None
    for d in days:
        h = history.scd2_capture(h, df.filter(F.col("capture_ts") == ts(d)), d).checkpoint()
    cols = ["user_id", "membership_tier", "region", "device_preference", "scd_valid_from", "scd_valid_to", "scd_id"]
    assert sorted(map(tuple, bulk.select(cols).collect()), key=str) == \
        sorted(map(tuple, h.select(cols).collect()), key=str)


def _dim(spark):
    caps = spark.createDataFrame(
        [(ts("2020-01-01"), "u1", "basic", "NA", "tv"),
         (ts("2021-01-01"), "u1", "premium", "NA", "tv"),
         (ts("2022-01-01"), "u1", "standard", "NA", "tv"),
         (ts("2021-01-01"), "u2", "basic", "EU", "tv")], CAP_COLS)
    caps = caps.withColumn("created_at", F.lit(None).cast("date"))
    return history.dim_user(history.scd2_from_captures(caps))


def test_dim_user_sentinels(spark):
    rows = sorted(_dim(spark).collect(), key=lambda r: (r.user_id, r.valid_from))
    u1 = [r for r in rows if r.user_id == "u1"]
    assert u1[0].valid_from == ts("1900-01-01") and u1[-1].valid_to == ts("9999-12-31")
    assert [r.is_current for r in u1] == [False, False, True]
    assert u1[0].valid_to == u1[1].valid_from == ts("2021-01-01")
    u2 = [r for r in rows if r.user_id == "u2"]
    assert len(u2) == 1 and u2[0].valid_from == ts("1900-01-01") and u2[0].is_current
    assert len({r.user_sk for r in rows}) == 4


def test_as_of_join_edges(spark):
    dim = _dim(spark)
    ev = spark.createDataFrame(
        [("u1", ts("2021-01-01"), "at_from"), ("u1", ts("2020-12-31 23:59:59"), "before"),
         ("u1", ts("2022-01-01"), "at_to"), ("zz", ts("2021-01-01"), "unknown")],
        "user_id string, rated_at timestamp, label string")
    out = {r.label: r.membership_tier for r in facts.rating_as_of(ev, dim, "user_id", "rated_at").collect()}
    assert out == {"at_from": "premium", "before": "basic", "at_to": "standard"}
    left = facts.rating_as_of(ev, dim, "user_id", "rated_at", how="left").collect()
    assert len(left) == 4 and [r.membership_tier for r in left if r.label == "unknown"] == [None]
    as_of = history.dim_user_as_of(dim, "2021-06-01").collect()
    assert sorted((r.user_id, r.membership_tier) for r in as_of) == [("u1", "premium"), ("u2", "basic")]


def test_overlaps_match_brute_force(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for u in range(20):
        for k in range(rnd.randint(1, 5)):
            a = rnd.randint(0, 50)
            rows.append((f"u{u}", f"u{u}-{k}", dt.datetime(2000, 1, 1) + dt.timedelta(days=a),
                         dt.datetime(2000, 1, 1) + dt.timedelta(days=a + rnd.randint(1, 20))))
    df = spark.createDataFrame(rows, "user_id string, user_sk string, valid_from timestamp, valid_to timestamp")
    got = {r.a_sk for r in history.version_overlaps(df).collect()}
    brute = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] != b[1] and a[2] < b[3] and a[3] > b[2]:
                later = max(a, b, key=lambda r: (r[2], r[1]))
                brute.add(later[1])
    assert got == brute


def test_latest_rating_spans_user_versions(spark):
    dim = _dim(spark)
    fact = (spark.createDataFrame(
        [("u1", ts("2020-06-01"), 2.0, "r1"), ("u1", ts("2021-06-01"), 4.5, "r2"),
         ("u2", ts("2021-06-01"), 3.0, "r3")],
        "user_id string, rated_at timestamp, rating_value double, rating_sk string")
        .withColumn("content_sk", F.lit("c1")))
    versioned = facts.rating_as_of(fact, dim, "user_id", "rated_at").select(
        "user_sk", "content_sk", "rated_at", "rating_value", "rating_sk")
    assert versioned.select("user_sk").distinct().count() == 3      # u1 rated under two versions
    latest = {r.user_id: r.rating_value for r in
              facts.latest_rating(facts.attach_user_id(versioned, dim)).collect()}
    assert latest == {"u1": 4.5, "u2": 3.0}


def test_overlaps_hot_key_spans_partitions(spark):
    import random
    rnd = random.Random(11)
    rows = []
    base = dt.datetime(2000, 1, 1)
    for k in range(600):                       # one key holds most versions
        a = rnd.randint(0, 5000)
        rows.append(("hot", f"h-{k:04d}", base + dt.timedelta(days=a), base + dt.timedelta(days=a + rnd.randint(1, 3))))
    for u in range(100):
        a = rnd.randint(0, 50)
        rows.append((f"u{u}", f"u{u}-0", base + dt.timedelta(days=a), base + dt.timedelta(days=a + 5)))
        rows.append((f"u{u}", f"u{u}-1", base + dt.timedelta(days=a + rnd.randint(3, 8)), base + dt.timedelta(days=a + 20)))
    df = spark.createDataFrame(rows, "user_id string, user_sk string, valid_from timestamp, valid_to timestamp")
    got = {(r.a_sk, r.b_sk) for r in history.version_overlaps(df, num_partitions=8).collect()}
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    want = set()
    for vs in by_key.values():
        vs.sort(key=lambda r: (r[2], r[1]))
        for i, a in enumerate(vs):
            if i == 0:
                continue
            w = max(vs[:i], key=lambda b: (b[3], b[2], b[1]))
            if a[2] < w[3] and a[3] > w[2]:
                want.add((a[1], w[1]))
    assert got == want and len(want) > 0
    parts = (df.repartitionByRange(8, "user_id", "valid_from", "user_sk")
             .filter("user_id = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1                           # the hot key really is split
