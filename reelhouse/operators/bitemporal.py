"""Bitemporal history: what was true when, and when it was known (late captures of C1/C2).

An observation says that a key had certain values at ``capture_ts``; it became known at
``recorded_ts``.  Captures may arrive late, in parts and in any order.  The history over
the observations known by a day is C2; this module keeps all of these histories at once: each
row is a version (valid_from, valid_to) together with the stretch of time in which it was believed
(recorded_from, recorded_to).  A late observation closes the belief in the versions that it splits,
shortens or moves and opens new ones; every other row stays as it is, so the number of rows grows
with the observations, not with observations times deliveries.

Rows are shuffled by key only and streamed through a task in order of recording; the state is one
key's observations, of which there is one per capture.

Defined cases: several observations of a key for one capture time: the one recorded last counts from
then on (in one delivery, the largest by its values); an observation that repeats what is
known changes nothing; nulls are values; a row without key, capture or recording time is none.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelhouse.operators.history import USER_CHECK_COLS


class _Beliefs:
    """The history of one key as known so far; :meth:`record` returns the rows that a delivery ends."""

    def __init__(self):
        self.times, self.values, self.starts = [], [], []
        self.believed: dict[int, tuple] = {}   # start of a version -> (values, end, known since)

    def _mark(self, i: int) -> int:
        """Keep ``starts`` right for the i-th observation."""
        t = self.times[i]
        at = bisect_left(self.starts, t)
        known = at < len(self.starts) and self.starts[at] == t
        if i == 0 or self.values[i] != self.values[i - 1]:
            if not known:
                self.starts.insert(at, t)
        elif known:
            del self.starts[at]
        return t

    def record(self, at: int, observations: list[tuple[int, tuple]]) -> list[tuple]:
        touched = set()
        for t, values in observations:
            i = bisect_left(self.times, t)
            if i < len(self.times) and self.times[i] == t:
                self.values[i] = values
            else:
                self.times.insert(i, t)
                self.values.insert(i, values)
            touched |= {self._mark(j) for j in (i, i + 1) if j < len(self.times)}
        for t in list(touched):
            k = bisect_left(self.starts, t) - 1
            if k >= 0:
                touched.add(self.starts[k])
        ended = []
        for t in touched:
            k = bisect_left(self.starts, t)
            now = None
            if k < len(self.starts) and self.starts[k] == t:
                end = self.starts[k + 1] if k + 1 < len(self.starts) else None
                now = (self.values[bisect_left(self.times, t)], end)
            was = self.believed.get(t)
            if was is None or was[:2] != now:
                if was is not None:
                    ended.append((*was[0], t, was[1], was[2], at))
                    del self.believed[t]
                if now is not None:
                    self.believed[t] = (*now, at)
        return ended

    def current(self) -> list[tuple]:
        return [(*values, t, end, since, None) for t, (values, end, since) in sorted(self.believed.items())]


def bitemporal_history(observations: DataFrame, key: str = "user_id", check_cols: Sequence[str] = USER_CHECK_COLS,
                       capture_ts: str = "capture_ts", recorded_ts: str = "recorded_ts") -> DataFrame:
    """(key, check columns, valid_from, valid_to, recorded_from, recorded_to); null ends are open."""
    cols = list(check_cols)
    rows = (observations.select(key, F.unix_micros(F.col(recorded_ts).cast("timestamp")).alias("_r"),
                                F.unix_micros(F.col(capture_ts).cast("timestamp")).alias("_t"), *cols)
            .filter(F.col(key).isNotNull() & F.col("_r").isNotNull() & F.col("_t").isNotNull())
            .repartition(key).sortWithinPartitions(key, "_r", "_t", *cols))
    fields = {f.name: f for f in rows.schema.fields}
    ends = ["valid_from", "valid_to", "recorded_from", "recorded_to"]
    schema = T.StructType([fields[key], *[fields[c] for c in cols], *[T.StructField(e, T.LongType()) for e in ends]])
    arrow = to_arrow_schema(schema)

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for name, of_key in groupby(one_by_one(batches), key=lambda r: r[0]):
            beliefs = _Beliefs()
            for at, delivery in groupby(of_key, key=lambda r: r[1]):
                out += [(name, *row) for row in beliefs.record(at, [(r[2], tuple(r[3:])) for r in delivery])]
            out += [(name, *row) for row in beliefs.current()]
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return rows.mapInArrow(run, schema).withColumns({e: F.timestamp_micros(e) for e in ends})


def as_known(history: DataFrame, at: str | Column) -> DataFrame:
    """The history as it was known at ``at``: plain versions, one valid at any time per key."""
    t = F.lit(at).cast("timestamp") if not isinstance(at, Column) else at
    known = (F.col("recorded_from") <= t) & (F.col("recorded_to").isNull() | (t < F.col("recorded_to")))
    return history.filter(known).drop("recorded_from", "recorded_to")


def restated(history: DataFrame, before: str, after: str) -> DataFrame:
    """Versions believed at ``before`` but no longer at ``after``: what later knowledge corrected."""
    t0, t1 = (F.lit(t).cast("timestamp") for t in (before, after))
    return history.filter((F.col("recorded_from") <= t0) & (t0 < F.col("recorded_to")) & (F.col("recorded_to") <= t1))
