"""Chunks of documents, and exact counts of hashed items over all of them.

Several operators need to know, for each window of words, how often it occurs in
the whole corpus.  One row per window would cost far more than the text, so rows
are columnar here: a *chunk* is a few megabytes of documents; its distinct hashes
are sorted, cut into buckets by their leading bits and sent as one delta-coded
blob per bucket.  A bucket adds the blobs up and answers each with one byte per
hash, in the blob's order, so neither positions nor hashes travel back.

    chunks --(chunk, bucket, sorted hashes)--> buckets --(chunk, bucket, answers)--> chunks

A hash that is in every document still costs one entry per chunk, so no key can be
hot.  Chunks are written once to the shared folder; a lost executor re-reads them.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import shared_files
from reelhouse.llm.words import slices
from reelhouse.session import checkpoint_root

CHUNK_BYTES = 5 << 20   # text per chunk; raise with the corpus (see README)
BUCKETS_PER_TASK = 2    # buckets per shuffle partition: smaller groups, more even tasks


def stage(df: DataFrame, name: str, shrink: int = 1) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut.
    ``shrink``: how many times fewer files than shuffle partitions, for rows of a few ids."""
    if shrink > 1:
        df = df.coalesce(max(1, shuffle_partitions(df.sparkSession) // shrink))
    path = f"{checkpoint_root(df.sparkSession)}/reelhouse-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Remove what :func:`stage` wrote, once nothing still to be computed reads it."""
    for df in staged:
        shared_files.remove_folder(df.staged_at)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_ints(values: np.ndarray) -> bytes:
    """64-bit integers as byte planes: planes that hardly vary cost nearly nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return squeeze(np.ascontiguousarray(planes).tobytes())


def unpack_ints(blob: bytes, dtype=np.uint64) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(blob), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack_ints(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(blob), dtype=np.uint64)


def pack_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_table(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


#: Name of the unique row number inside a chunk's table, before the carried columns.
ROW = "_row"


def stage_chunks(docs: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks (chunk, n_bytes, docs) of ``docs``, written once.

    Inside a chunk the documents are sorted by id (null first), so positions in it
    follow document order.  Its columns: _id, _text, ROW (unique over the corpus), then
    the carried ones as c0, c1, ...  Repeated ids stay separate rows."""
    wanted = [F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")]
    wanted += [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        row, held, size = 0, [], 0

        def close():
            nonlocal row
            table = pa.Table.from_batches(held).combine_chunks()
            table = table.take(pa.compute.sort_indices(table, sort_keys=[("_id", "ascending")],
                                                       null_placement="at_start"))
            rows = pa.array(np.arange(len(table), dtype=np.int64) + first + row)
            table = table.add_column(2, ROW, rows)
            chunk, row = first + row, row + len(table)
            return pa.RecordBatch.from_pydict({"chunk": [chunk], "n_bytes": [size], "docs": [pack_table(table)]},
                                              schema=pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()),
                                                                ("docs", pa.binary())]))

        for batch in batches:
            for part in slices(batch, 1, chunk_bytes // 4):
                held.append(part)
                size += part.nbytes
                if size >= chunk_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()
        pa.default_memory_pool().release_unused()

    return stage(docs.select(*wanted).mapInArrow(run, "chunk long, n_bytes long, docs binary"), "chunks")


def key_bits(chunks: DataFrame, spare: int = 6) -> int:
    """Bits of the filter's hashes: enough that few of the corpus's windows meet by
    chance (one window needs two bytes of text at least)."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 2
    return min(64, max(24, math.ceil(math.log2(max(2, total))) + spare))


def bucket_bounds(n_buckets: int, bits: int) -> np.ndarray:
    """First key of each bucket after the first, for keys of ``bits`` bits."""
    return np.array([(i << bits) // n_buckets for i in range(1, n_buckets)], dtype=np.uint64)


def answers(blobs: DataFrame) -> DataFrame:
    """(chunk, bucket, keys, counts) -> (chunk, bucket, reply): for each key of the
    blob its count over all chunks, at most 255, one byte each."""

    def total(pdf):
        import pandas as pd

        keys = [unpack_sorted(b) for b in pdf["keys"]]
        counts = np.concatenate([np.frombuffer(unsqueeze(b), dtype=np.uint8) for b in pdf["counts"]])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.minimum(np.bincount(at, weights=counts), 255).astype(np.uint8)[at]
        ends = np.cumsum([len(k) for k in keys])
        parts = np.split(sums, ends[:-1])
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"],
                             "reply": [squeeze(p.tobytes()) for p in parts]})

    return blobs.groupBy("bucket").applyInPandas(total, "chunk long, bucket int, reply binary")


def count_blobs(keys: np.ndarray, bounds: np.ndarray):
    """Rows (bucket, keys, counts) of one chunk; ``keys`` may repeat."""
    distinct, counts = np.unique(keys, return_counts=True)
    counts = np.minimum(counts, 255).astype(np.uint8)
    cuts = [0, *np.searchsorted(distinct, bounds), len(distinct)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            yield i, pack_sorted(distinct[a:b]), squeeze(counts[a:b].tobytes())


def totals(replies: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Corpus count of each entry of ``keys``, from the replies in bucket order."""
    if not len(keys):
        return np.zeros(0, dtype=np.uint8)
    _, at = np.unique(keys, return_inverse=True)
    return np.concatenate([np.frombuffer(unsqueeze(r), dtype=np.uint8) for r in replies])[at]


def with_replies(chunks: DataFrame, replies: DataFrame, columns: list[str],
                 fn: Callable[[dict, list[bytes]], Iterator], schema: str) -> DataFrame:
    """Bring each chunk's replies to it: ``fn(chunk row, replies in bucket order)``
    yields pandas frames.  A chunk without replies is passed too."""
    left = chunks.select("chunk", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("reply"),
                         *columns)
    right = replies.select("chunk", "bucket", "reply",
                           *[F.lit(None).cast(dict(chunks.dtypes)[c]).alias(c) for c in columns])

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("bucket", kind="stable")
        if pdf["bucket"].iloc[0] != -1:
            raise RuntimeError("replies without their chunk")
        frames = [f.reindex(columns=names).astype(object) for f in
                  fn({"chunk": pdf["chunk"].iloc[0]} | {c: pdf[c].iloc[0] for c in columns},
                     list(pdf["reply"].iloc[1:]))]
        return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=names)

    names = [x.split()[0] for x in schema.split(",")]
    return left.unionByName(right).groupBy("chunk").applyInPandas(run, schema)


def meet(chunks: DataFrame, replies: DataFrame, columns: list[str],
         fn: Callable[[dict, list[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """As :func:`with_replies`, in Arrow: ``fn`` yields record batches, each of which leaves the
    task before the next is made, so a chunk's results are never held together."""
    left = chunks.select("chunk", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("reply"), *columns)
    right = replies.select("chunk", "bucket", "reply",
                           *[F.lit(None).cast(dict(chunks.dtypes)[c]).alias(c) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("bucket")
        if table["bucket"][0].as_py() != -1:
            raise RuntimeError("replies without their chunk")
        row = {c: table[c][0].as_py() for c in ["chunk", *columns]}
        reply = table["reply"][1:].to_pylist()
        del table, batches
        yield from fn(row, reply)
        pa.default_memory_pool().release_unused()

    return left.unionByName(right).groupBy("chunk").applyInArrow(run, schema)
