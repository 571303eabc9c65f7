"""Approximate nearest neighbours by a permutation index (operator 7).

A vector is represented by its nearest pivots in order of nearness.  It is posted, with
the pivot's place in that order, in the inverted file of each of these pivots.  A query opens
the files of a few of its own nearest pivots only and adds up, over the vectors posted there, how far
Spearman's footrule falls short of its largest value: the posted length less the distance between the
two places of the pivot.  Vectors in none of the opened files cost nothing.  Those of least footrule are
ranked again by the exact cosine.

The files are built per block of vectors, so neither a file nor a task grows with the corpus.  A block is
read once and the query blocks stream past it.  Equal vectors of a block are posted once, with all their
ids, so that a very common vector crowds no other out.  Pivots are a bounded sample (of the rows of smallest hash, the
first different vectors), every row is indexed, and of every block the same share of its different vectors is ranked
exactly (at least k + 1 of them): a small block is not searched more closely than a full one.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold a
null or non-finite component are neither indexed nor searched; a query's own row (and any row
with its id) is no candidate; ties go to the smaller id; repeated query rows give repeated
results only once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.chunks import stage

PIVOTS = 1024
POSTED = 192          # nearest pivots under which a vector is posted, 256 at most
OPENED = 96           # nearest pivots whose files a query opens
BLOCK = 4096          # vectors per block of inverted files, 65536 at most
QUERIES = 512         # queries per query block
SHARE = 1 / 8         # of a block's different vectors that is ranked by cosine
SAMPLED = 4           # rows drawn per pivot, so that copies of one vector do not use the pivots up
BROADCAST_BLOCKS = 1_000_000   # block numbers, 8 bytes each, that are broadcast at most


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, components as doubles."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vec")).filter(
        F.col("id").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vec", lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return rows.filter(F.size("vec") == (size["dim"] if size else 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square overflows; cosines stay exactly the same."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / _norms(x)[:, None]


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``q``, row by row: equal rows have equal cosines to the last bit."""
    return (x * q).sum(axis=1) / (_norms(x) * np.sqrt((q * q).sum()))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` nearest pivots of each unit vector, nearest first."""
    far = -(x @ pivots.T)
    some = np.sort(np.argpartition(far, count - 1, axis=1)[:, :count], axis=1)
    order = np.argsort(np.take_along_axis(far, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def choose_pivots(rows: DataFrame, count: int) -> np.ndarray:
    """At most ``count`` different unit vectors: of the ``SAMPLED`` x ``count`` rows of smallest hash the first."""
    sample = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(SAMPLED * count).collect()  # bounded
    different = list(dict.fromkeys(tuple(r["vec"]) for r in sample))[:count]
    return _unit(np.array(different)) if different else np.empty((0, 0))


INDEX = ("block long, query_block long, ids binary, copies binary, vecs binary, lengths binary, members binary, "
         "places binary")


def build_index(rows: DataFrame, pivots: np.ndarray, posted: int = POSTED, block: int = BLOCK) -> DataFrame:
    """A row per block of vectors: its different vectors, in order of their smallest ids, with the ids of each
    (``copies`` of them), and its inverted files end to end, in order of pivots, each file in order of places
    (``lengths`` of the files, ``members``: numbers of different vectors)."""
    schema = pa.schema([("block", pa.int64()), ("query_block", pa.int64())]
                       + [(c, pa.binary()) for c in ("ids", "copies", "vecs", "lengths", "members", "places")])

    def files(number: int, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.ascontiguousarray(x[order], "<f8")
        _, first, group = np.unique(x.view(f"V{x.shape[1] * 8}").reshape(-1), return_index=True, return_inverse=True)
        number_of = np.argsort(np.argsort(first))[group]  # in order of smallest ids: ties go to smaller ids
        ids, x = ids[np.argsort(number_of, kind="stable")], x[np.sort(first)]
        near = nearest_pivots(_unit(x), pivots, posted)
        places = np.arange(posted, dtype=np.int32)
        key = (near.astype(np.int32) * posted + places).reshape(-1)
        by = np.argsort(key, kind="stable")
        lengths = np.bincount(near.reshape(-1), minlength=len(pivots))
        return pa.RecordBatch.from_pydict(
            {"block": [number], "query_block": [None], "ids": [ids.astype("<i8").tobytes()],
             "copies": [np.bincount(number_of).astype("<u4").tobytes()], "vecs": [x.tobytes()],
             "lengths": [lengths.astype("<u4").tobytes()], "members": [(by // posted).astype("<u2").tobytes()],
             "places": [(key[by] % posted).astype("u1").tobytes()]}, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, xs, n = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                ids.append(part.column(0).to_numpy())
                xs.append(_matrix(part.column(1)))
                n += len(part)
                if n >= block:
                    all_ids, all_x = np.concatenate(ids), np.concatenate(xs)
                    yield files(number, all_ids[:block], all_x[:block])
                    ids, xs, n, number = [all_ids[block:]], [all_x[block:]], n - block, number + 1
        if n:
            yield files(number, np.concatenate(ids), np.concatenate(xs))

    return stage(rows.mapInArrow(run, INDEX), "inverted-files")


def ranked_exactly(size: int, k: int) -> int:
    """How many vectors of a block of ``size`` are ranked by cosine: the same share of every block, k + 1 at least."""
    return min(size, max(k + 1, int(np.ceil(SHARE * size))))


class Block:
    """One block's inverted files, opened for queries."""

    def __init__(self, row: dict, posted: int):
        self.posted = posted
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.copies = np.frombuffer(row["copies"], "<u4")
        self.until = np.cumsum(self.copies, dtype=np.int64)
        self.x = _scaled(np.frombuffer(row["vecs"], "<f8").reshape(len(self.until), -1))
        self.ends = np.concatenate([[0], np.cumsum(np.frombuffer(row["lengths"], "<u4"), dtype=np.int64)])
        self.members = np.frombuffer(row["members"], "<u2").astype(np.intp)
        self.places = np.frombuffer(row["places"], "u1").astype(np.int16)

    def footrules(self, order: np.ndarray) -> np.ndarray:
        """Per vector, what its footrule to a query with these nearest pivots lacks of the largest, by the opened files."""
        starts, ends = self.ends[order], self.ends[order + 1]
        spans = [slice(a, b) for a, b in zip(starts.tolist(), ends.tolist())]
        members = np.concatenate([self.members[s] for s in spans])
        near = np.concatenate([self.places[s] for s in spans])
        near -= np.repeat(np.arange(len(order), dtype=np.int16), ends - starts)
        np.abs(near, out=near)
        return np.bincount(members, weights=self.posted - near, minlength=len(self.until)).astype(np.int64)

    def nearest(self, qid: int, query: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the k best rows among the block's share of least footrule."""
        near, size = self.footrules(order), len(self.until)
        mine, rows = np.unique(np.searchsorted(self.until, np.flatnonzero(self.ids == qid), "right"), return_counts=True)
        own = mine[rows == self.copies[mine]]  # vectors of the query's id alone
        near[own] = -1
        ranked = -near * size + np.arange(size)  # ties to smaller ids
        take = ranked_exactly(size, k)
        best = np.argpartition(ranked, take - 1)[:take]
        best = best[near[best] >= 0]
        score = cosines(self.x[best], query)
        # each vector has a row that is not the query's: k rows stand in the k best, and in the first k of each
        some = np.argsort(-score, kind="stable")
        some = some[score[some] >= score[some[min(k, len(some)) - 1]]] if len(some) else some
        ids, scores = [np.empty(0, "<i8")], [np.empty(0)]
        for b, cosine in zip(best[some], score[some]):
            copies = self.ids[self.until[b - 1] if b else 0:self.until[b]]
            copies = copies[copies != qid][:k]
            ids.append(copies)
            scores.append(np.full(len(copies), cosine))
        ids, scores = np.concatenate(ids), np.concatenate(scores)
        top = np.lexsort((ids, -scores))[:k]
        return ids[top], scores[top]


def query_blocks(asked: DataFrame) -> DataFrame:
    """(query_block, ids, vecs): the queries in blocks of ``QUERIES`` at most, staged."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.slice(at, QUERIES)
                yield pa.RecordBatch.from_pydict(
                    {"query_block": [number], "ids": [part.column(0).to_numpy().astype("<i8").tobytes()],
                     "vecs": [_matrix(part.column(1)).astype("<f8").tobytes()]})
                number += 1

    return stage(asked.coalesce(max(1, asked.rdd.getNumPartitions() // 8))
                 .mapInArrow(blocks, "query_block long, ids binary, vecs binary"), "query-blocks")


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            pivots: int = PIVOTS, posted: int = POSTED, opened: int = OPENED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row where the condition
    ``is_query`` (on a column ``id``) holds, by cosine."""
    rows = usable(vectors, id_col, vec_col)
    base = choose_pivots(rows, pivots)
    if not len(base):
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    posted = min(posted, len(base))
    opened = min(opened, posted)
    index = build_index(rows, base, posted)
    queries = query_blocks(rows.filter(is_query).dropDuplicates(["id"]))
    numbers = index.select("block")
    blocks = numbers.count()
    # the stated query set meets all rows, in blocks: queries are copied to the blocks, a block is sent once
    sent = queries.crossJoin(F.broadcast(numbers) if blocks <= BROADCAST_BLOCKS else numbers)
    met = (index.unionByName(sent, allowMissingColumns=True).repartition(blocks, "block")
           .sortWithinPartitions("block", F.col("query_block").asc_nulls_first()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = None
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if row["query_block"] is None:
                    files = Block(row, posted)
                    continue
                ids = np.frombuffer(row["ids"], "<i8")
                q = _scaled(np.frombuffer(row["vecs"], "<f8").reshape(len(ids), -1))
                found = [files.nearest(qid, v, order, k)
                         for qid, v, order in zip(ids, q, nearest_pivots(_unit(q), base, opened))]
                yield pa.RecordBatch.from_pydict(
                    {"query_id": np.repeat(ids, [len(f) for f, _ in found]),
                     "vec_id": np.concatenate([f for f, _ in found]),
                     "score": np.concatenate([s for _, s in found])})

    found = met.mapInArrow(search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
