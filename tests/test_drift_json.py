"""Drift of two samples, JSON objects with changing fields, interval join of two streams."""

import datetime as dt
import math
import random
from collections import Counter

import pytest

from reelhouse.operators.drift import drift
from reelhouse.sources.semistructured import parse_object, rescued_fields
from reelhouse.streaming.interval_join import interval_join
from reelhouse.streaming.ratings_stream import run_available_now

T0 = dt.datetime(2000, 1, 1)


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def brute(a, b, buckets=4):
    def cells(values, lo, hi):
        return Counter(None if v is None else 0 if lo == hi else min(buckets - 1, int((v - lo) * buckets / (hi - lo))) for v in values)
    there = [v for v in a + b if v is not None]
    x, y = cells(a, min(there), max(there)), cells(b, min(there), max(there))
    keys = sorted(set(x) | set(y), key=lambda k: -1 if k is None else k)
    psi = ks = cx = cy = 0
    for k in keys:
        p, q = (x[k] + .5) / (len(a) + .5 * len(keys)), (y[k] + .5) / (len(b) + .5 * len(keys))
        psi += (q - p) * math.log(q / p)
        cx, cy = cx + x[k], cy + y[k]
        ks = max(ks, abs(cx / len(a) - cy / len(b)))
    return psi, ks


@pytest.mark.parametrize("a, b", [([1, 2, 3, 4, None], [1, 2, 3, 4, None]), ([0] * 50 + [9], [9] * 50 + [0]), ([5, 5], [5, None]),
                                  ([random.Random(1).gauss(0, 1) for _ in range(300)], [random.Random(2).gauss(1, 1) for _ in range(200)])])
def test_drift(spark, a, b):
    def df(values):
        return spark.createDataFrame([(None if v is None else float(v), "x" if v else "y") for v in values], "n double, c string")
    got = by_column(drift(df(a), df(b), ["n"], ["c"], buckets=4))
    psi, ks = brute(a, b)
    assert math.isclose(got["n"].psi, psi, abs_tol=1e-12) and math.isclose(got["n"].ks, ks, abs_tol=1e-12)
    assert got["c"].ks is None and got["n"].status == ("fail" if psi > 0.2 else "pass") and (got["n"].n_before, got["n"].n_after) == (len(a), len(b))


def test_drift_against_an_empty_sample(spark):
    some, none = spark.createDataFrame([(1.0,), (2.0,)], "n double"), spark.createDataFrame([], "n double")
    got = by_column(drift(none, some, ["n"]))
    assert got["n"].n_before == 0 and math.isfinite(got["n"].psi)
    assert drift(none, none, ["n"]).isEmpty()


def test_json_fields_are_rescued(spark):
    rows = [(1, '{"k": 7, "t": "a"}'), (2, '{"k": "7"}'), (3, '{"k": "x", "new": 2}'), (4, '{"t": null, "deep": {"a": [1]}}'),
            (5, "{broken"), (6, None), (7, "[1, 2]"), (8, "{}"), (9, '{"k": 99999999999}')]
    parsed = parse_object(spark.createDataFrame(rows, "id int, j string"), "j", {"k": "int", "t": "string"})
    got = {r.id: (r.k, r.t, r._rescued, r._malformed) for r in parsed.collect()}
    assert got == {1: (7, "a", None, False), 2: (7, None, None, False), 3: (None, None, {"k": "x", "new": "2"}, False),
                   4: (None, None, {"deep": '{"a":[1]}'}, False), 5: (None, None, None, True), 6: (None, None, None, False),
                   7: (None, None, None, True), 8: (None, None, None, False), 9: (None, None, {"k": "99999999999"}, False)}
    assert {r.field: r.n for r in rescued_fields(parsed).collect()} == {"k": 2, "new": 1, "deep": 1}


def test_interval_join_of_streams_equals_the_batch(spark, tmp_dir):
    r = random.Random(6)

    def rows(n):
        out = [(r.choice([1, 1, 1, 2, 3, None]), T0 + dt.timedelta(minutes=r.randint(0, 600)), i) for i in range(n)]
        return sorted(out, key=lambda x: x[1])

    frames = []
    for name, at in (("l", "a"), ("r", "b")):
        schema, data = f"k int, {at} timestamp, {name} int", rows(60)
        data[0] = (1, T0, data[0][2])
        for i in range(3):
            spark.createDataFrame(data[i * 20:(i + 1) * 20], schema).coalesce(1).write.parquet(f"{tmp_dir}/{name}/part={i}")
        stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true")
                  .parquet(f"{tmp_dir}/{name}"))
        frames.append((spark.createDataFrame(data, schema), stream))
    (lb, ls), (rb, rs) = frames
    batch = interval_join(lb, rb, ["k"], "a", "b", "30 MINUTES", "1 hour")
    run_available_now(interval_join(ls, rs, ["k"], "a", "b", "30 MINUTES", "1 hour"), tmp_dir + "/o", tmp_dir + "/c")
    got = spark.read.parquet(tmp_dir + "/o").select(*batch.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect())) and batch.count() > 5
    assert batch.filter("b < a OR b > a + INTERVAL 30 MINUTES").isEmpty()
