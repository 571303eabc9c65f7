import datetime as dt
import os

import pytest

from reelhouse.operators.history import SnapshotError, scd2_from_captures
from reelhouse.sources import files
from reelhouse.streaming import ratings_stream, scd2_stream

HEADER = "userId,movieId,rating,timestamp\n"
DAY = 86400
T0 = 1_000_000_000


def _write(path, rows):
    with open(path, "w") as fh:
        fh.write(HEADER + "".join(f"{u},{m},{r},{t}\n" for u, m, r, t in rows))


def _run(spark, src, out, lateness):
    raw = ratings_stream.ratings_csv_stream(spark, src, max_files_per_trigger=1)
    ratings_stream.run_available_now(ratings_stream.silver_ratings_stream(raw, lateness), out + "/o", out + "/c")
    return spark.read.parquet(out + "/o")


def test_replays_removed_collisions_kept(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(f"{src}/a.csv", [(1, 10, 3.0, T0), (2, 10, 4.0, T0 + 5), (3, 11, 9.0, T0)])
    # replay of a row, plus a different rating in the same second (rating_sk collision)
    _write(f"{src}/b.csv", [(1, 10, 3.0, T0), (1, 10, 4.5, T0), (4, 12, 2.0, T0 + DAY)])
    got = _run(spark, src, tmp_dir + "/s1", "3650 days")
    batch = ratings_stream.batch_equivalent(spark.read.option("header", "true")
                                            .schema("userId long, movieId long, rating double, timestamp long")
                                            .csv(src))
    cols = ["user_id", "movie_id", "rating_value", "rated_at"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert got.count() == 4          # 9.0 is out of range; the replay is gone; both values of user 1 kept


def test_late_rows_beyond_the_bound_are_reported(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(f"{src}/a.csv", [(1, 10, 3.0, T0 + 30 * DAY)])
    _write(f"{src}/b.csv", [(2, 10, 3.0, T0 + 31 * DAY)])
    _write(f"{src}/c.csv", [(3, 10, 3.0, T0), (4, 10, 3.0, T0 + 29 * DAY)])   # 31 and 2 days late
    tight = _run(spark, src, tmp_dir + "/tight", "7 days")
    loose = _run(spark, src, tmp_dir + "/loose", "60 days")
    assert sorted(r.user_id for r in tight.collect()) == ["1", "2", "4"]
    assert sorted(r.user_id for r in loose.collect()) == ["1", "2", "3", "4"]
    staged = ratings_stream.stage_ratings(files.scan_ratings(spark, src))
    assert [r.user_id for r in ratings_stream.too_late(staged, tight).collect()] == ["3"]
    assert ratings_stream.too_late(staged, loose).isEmpty()


def test_stateless_sink_takes_late_rows_and_no_replays(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(f"{src}/a.csv", [(1, 10, 3.0, T0 + 30 * DAY), (1, 10, 3.5, T0 + 30 * DAY)])
    _write(f"{src}/b.csv", [(1, 10, 3.0, T0 + 30 * DAY), (2, 10, 3.0, T0)])        # a replay, and a month late
    _write(f"{src}/c.csv", [(2, 10, 3.0, T0), (2, 10, 3.0, T0)])
    raw = ratings_stream.ratings_csv_stream(spark, src, max_files_per_trigger=1)
    got = ratings_stream.run_silver_ratings(raw, tmp_dir + "/o", tmp_dir + "/c")
    assert sorted((r.user_id, float(r.rating_value)) for r in got.collect()) == [("1", 3.0), ("1", 3.5), ("2", 3.0)]


CAPS = "capture_ts timestamp, user_id string, membership_tier string, region string, device_preference string"


def test_scd2_replays_parts_and_order(spark, tmp_dir):
    """Parts of captures in any order and twice give the history of the whole captures."""
    d = [dt.datetime(2020 + i, 1, 1) for i in range(3)]
    whole = [(d[0], "u1", "basic", "NA", "tv"), (d[0], "u2", "basic", "EU", "tv"), (d[1], "u1", "premium", "NA", "tv"),
             (d[1], "u2", "basic", "EU", "tv"), (d[2], "u1", "basic", "NA", "tv"), (d[2], "u3", "basic", "EU", "tv")]
    fn = scd2_stream.store_batch(tmp_dir + "/t")
    for batch_id, part in enumerate(([whole[4]], whole[0:1], [whole[3], whole[5]], [whole[2], whole[1]], [whole[2]])):
        fn(spark.createDataFrame(part, CAPS), batch_id)
    fn(spark.createDataFrame([whole[2]], CAPS), 4)     # a replayed batch id
    got = scd2_stream.user_history(spark, tmp_dir + "/t")
    want = scd2_from_captures(spark.createDataFrame(whole, CAPS))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.count() == 5


def test_scd2_contradiction_and_failed_read(spark, tmp_dir):
    fn = scd2_stream.store_batch(tmp_dir + "/t")
    t = dt.datetime(2020, 1, 1)
    fn(spark.createDataFrame([(t, "u1", "basic", "NA", "tv")], CAPS), 0)
    fn(spark.createDataFrame([(t, "u1", "premium", "NA", "tv")], CAPS), 1)
    with pytest.raises(SnapshotError):
        scd2_stream.user_history(spark, tmp_dir + "/t")
    with pytest.raises(Exception):
        scd2_stream.user_history(spark, tmp_dir + "/nothing-here")
