"""Substring dedup by level-wise doubling of repeated word windows (operator 10).

Windows of ``base_words`` words are counted over the whole corpus.  Where a window
repeats and the one right after it repeats too, the two together are a candidate
at twice the length; all other positions are dropped for good.  Doubling goes on
until the target length is reached or no candidate survives.  Early levels count
narrow hashes (a chance match only keeps a candidate longer); the target level
decides on hashes so wide that no two different windows of the corpus meet, and
looks up the first occurrence of each.

Result: every word covered by a window that also starts earlier (smaller id, or
the same document further left) is cut out.  The layout between kept words stays.

Defined cases: null text counts as empty and comes back null; a null id sorts
before all others; rows with equal ids are separate documents, the order among them is
that of their staged rows; a text shorter than the window never changes; an empty
table gives an empty result; other columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import chunks as C
from reelhouse.llm.words import Words, window_hashes, words_of

NO_ID = np.iinfo(np.int64).min
RESULT_BYTES = 1 << 20   # text per returned batch
RESULT = "id long, n_words long, n_removed long, text string, sha string"


def _windows(words: Words, length: int, alive: np.ndarray | None, stream: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of candidate windows and their hashes."""
    h = window_hashes(words.hashes(stream=stream), length)
    at = np.flatnonzero(words.room() >= length) if alive is None else alive
    return at, h[at]


def _pack_positions(at: np.ndarray) -> bytes:
    return C.pack_ints(np.diff(at, prepend=0).astype(np.int64))


def _unpack_positions(blob: bytes) -> np.ndarray:
    return np.cumsum(C.unpack_ints(blob, np.int64))


def _alive(row: dict) -> np.ndarray | None:
    return None if row["alive"] is None else _unpack_positions(row["alive"])


def _count_level(level: DataFrame, length: int, bits: int, bounds: np.ndarray) -> DataFrame:
    """Corpus counts of the candidate windows of one level, as replies to the chunks."""
    def emit(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = words_of(C.unpack_table(row["docs"])["_text"])
                _, keys = _windows(words, length, _alive(row))
                found = list(C.count_blobs(keys >> np.uint64(64 - bits), bounds))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [row["chunk"]] * len(found), "bucket": [f[0] for f in found],
                     "keys": [f[1] for f in found], "counts": [f[2] for f in found]},
                    schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()),
                                      ("keys", pa.binary()), ("counts", pa.binary())]))

    blobs = level.select("chunk", "docs", "alive").mapInArrow(
        emit, "chunk long, bucket int, keys binary, counts binary")
    return C.answers(blobs)


def _finished(table: pa.Table, words: Words, keep: np.ndarray | None, extra: list[str],
              pick: np.ndarray | None = None) -> Iterator[dict]:
    """Columns of the result rows of the documents ``pick`` (all by default), a slice of about
    RESULT_BYTES at a time; ``keep`` marks kept words.  The digest is of the kept words joined by one space."""
    if pick is None:
        pick = np.arange(len(table))
    n, sizes, a = words.n_words, np.cumsum(np.diff(words.doc_bytes)[pick]), 0
    while a < len(pick):
        z = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + RESULT_BYTES, side="right")))
        rows = table.take(pick[a:z])
        texts, removed, digests = rows["_text"].to_pylist(), [], []
        for k, d in enumerate(pick[a:z]):
            first, last = words.doc_words[d], words.doc_words[d + 1]
            kept = np.ones(last - first, dtype=bool) if keep is None else keep[first:last]
            at = np.flatnonzero(kept) + first
            digests.append(hashlib.sha256(b" ".join(
                words.data[x:y].tobytes() for x, y in zip(words.starts[at], words.ends[at]))).hexdigest())
            removed.append(int(len(kept) - len(at)))
            if removed[-1]:
                edges = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]]).astype(np.int8)))
                end = words.doc_bytes[d + 1]
                texts[k] = b"".join(
                    words.data[words.starts[first + x]:words.starts[first + y] if first + y < last else end].tobytes()
                    for x, y in zip(edges[::2], edges[1::2])).decode("utf-8")
        yield {"id": rows["_id"].combine_chunks(), "n_words": pa.array(n[pick[a:z]]),
               "n_removed": pa.array(removed, pa.int64()), "text": pa.array(texts, pa.string()),
               "sha": pa.array(digests, pa.string())} | {f"x{i}": rows[f"c{i}"].combine_chunks() for i in range(len(extra))}
        a = z


def _next_level(level: DataFrame, replies: DataFrame, length: int, bits: int, extra: list[str],
                extra_schema: str) -> DataFrame:
    """Rows of finished documents (chunk null) and of chunks cut down to the documents
    that still have a candidate window of twice the length (docs, alive)."""
    def run(row: dict, reply: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = C.unpack_table(row["docs"])
        words = words_of(table["_text"])
        at, keys = _windows(words, length, _alive(row))
        repeated = np.zeros(len(words.starts) + length + 1, dtype=bool)
        repeated[at[C.totals(reply, keys >> np.uint64(64 - bits)) > 1]] = True
        grown = np.flatnonzero(repeated[:len(words.starts)] & repeated[length:length + len(words.starts)]
                               & (words.room() >= 2 * length))
        doc = np.searchsorted(words.doc_words, grown, side="right") - 1
        going = np.unique(doc)
        over = np.setdiff1d(np.arange(len(table)), going)
        for columns in _finished(table, words, None, extra, over):
            none = len(columns["id"])
            yield pa.RecordBatch.from_pydict({"chunk": pa.nulls(none, pa.int64()), "docs": pa.nulls(none, pa.binary()),
                                              "alive": pa.nulls(none, pa.binary())} | columns)
        if len(going):
            n = words.n_words
            shift = words.doc_words[:-1].copy()
            shift[going] -= np.concatenate([[0], np.cumsum(n[going])[:-1]])
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([row["chunk"]], pa.int64()), "docs": pa.array([C.pack_table(table.take(going))], pa.binary()),
                "alive": pa.array([_pack_positions(grown - shift[doc])], pa.binary()),
                **{c: pa.nulls(1, pa.int64()) for c in ("id", "n_words", "n_removed")},
                **{c: pa.nulls(1, pa.string()) for c in ("text", "sha")},
                **{f"x{i}": pa.nulls(1, table[f"c{i}"].type) for i in range(len(extra))}})

    return C.meet(level, replies, ["docs", "alive"], run, "chunk long, docs binary, alive binary, " + RESULT + extra_schema)


def _first_occurrences(level: DataFrame, length: int, wide_bits: int, bounds: np.ndarray) -> DataFrame:
    """For each chunk and distinct candidate window of it: 1 if the window's first
    occurrence in the corpus is in this chunk, else 0 (one byte each, key order)."""
    second = np.uint64(64 - min(64, wide_bits - 64))

    def emit(batches):
        for batch in batches:
            for row in batch.to_pylist():
                table = C.unpack_table(row["docs"])
                words = words_of(table["_text"])
                order, _, head = _distinct(words, length, _alive(row), second)
                at, key, more = (x[head] for x in order)
                ids = table["_id"].fill_null(NO_ID).to_numpy()
                owner = ids[np.searchsorted(words.doc_words, at, side="right") - 1]
                cuts = [0, *np.searchsorted(key, bounds), len(key)]
                found = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [row["chunk"]] * len(found), "bucket": [i for i, _, _ in found],
                     "keys": [C.pack_sorted(key[a:b]) for _, a, b in found],
                     "more": [C.pack_ints(more[a:b]) for _, a, b in found],
                     "ids": [C.pack_ints(owner[a:b]) for _, a, b in found]},
                    schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()),
                                      ("more", pa.binary()), ("ids", pa.binary())]))

    def first(pdf):
        keys = [C.unpack_sorted(b) for b in pdf["keys"]]
        key = np.concatenate(keys)
        more = np.concatenate([C.unpack_ints(b) for b in pdf["more"]])
        ids = np.concatenate([C.unpack_ints(b, np.int64) for b in pdf["ids"]])
        sizes = [len(k) for k in keys]
        chunk = np.repeat(pdf["chunk"].to_numpy(), sizes)
        order = np.lexsort((chunk, ids, more, key))
        k, m = key[order], more[order]
        leads = np.ones(len(k), dtype=np.uint8)
        leads[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        owns = np.empty(len(k), dtype=np.uint8)
        owns[order] = leads
        parts = np.split(owns, np.cumsum(sizes)[:-1])
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"],
                             "reply": [C.squeeze(p.tobytes()) for p in parts]})

    blobs = level.select("chunk", "docs", "alive").mapInArrow(
        emit, "chunk long, bucket int, keys binary, more binary, ids binary")
    return blobs.groupBy("bucket").applyInPandas(first, "chunk long, bucket int, reply binary")


def _distinct(words: Words, length: int, alive, second: np.uint64):
    """Candidate windows in (key, second key, position) order: that order's (position,
    key, second key), the group of each entry, and where each group begins."""
    at, key = _windows(words, length, alive)
    more = window_hashes(words.hashes(stream=1), length)[at] >> second if len(at) else key
    order = np.lexsort((at, more, key))
    at, key, more = at[order], key[order], more[order]
    head = np.ones(len(at), dtype=bool)
    head[1:] = (key[1:] != key[:-1]) | (more[1:] != more[:-1])
    return (at, key, more), np.cumsum(head) - 1, np.flatnonzero(head)


def _cut(level: DataFrame, replies: DataFrame, length: int, wide_bits: int, extra: list[str],
         extra_schema: str) -> DataFrame:
    second = np.uint64(64 - min(64, wide_bits - 64))

    def run(row: dict, reply: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = C.unpack_table(row["docs"])
        words = words_of(table["_text"])
        (at, _, _), group, head = _distinct(words, length, _alive(row), second)
        keep = np.ones(len(words.starts), dtype=bool)
        if len(at):
            later = np.ones(len(at), dtype=bool)
            later[head] = np.concatenate([np.frombuffer(C.unsqueeze(r), dtype=np.uint8) for r in reply]) == 0
            edge = np.zeros(len(words.starts) + 1, dtype=np.int64)
            np.add.at(edge, at[later], 1)
            np.add.at(edge, at[later] + length, -1)
            keep = np.cumsum(edge[:-1]) == 0
        for columns in _finished(table, words, keep, extra):
            yield pa.RecordBatch.from_pydict(columns)

    return C.meet(level, replies, ["docs", "alive"], run, RESULT + extra_schema)


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                            base_words: int = 10, carry: list[str] | None = None,
                            chunk_bytes: int = C.CHUNK_BYTES, digest: str | None = None) -> DataFrame:
    """(id, n_words, n_removed, text, carried columns) per document; see the module.

    ``window`` must be ``base_words`` doubled some number of times.  ``digest`` names a column
    with the SHA-256 of the kept words joined by one space, made where the words are."""
    extra = list(carry or [])
    out_names = [id_col, "n_words", "n_removed", text_col] + ([digest] if digest else [])
    if set(extra) & set(out_names):
        raise ValueError(f"carried columns clash with the result's: {sorted(set(extra) & set(out_names))}")
    doublings = (window // base_words).bit_length() - 1
    if base_words << doublings != window:
        raise ValueError("window must be base_words times a power of two")
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    extra_schema = "".join(f", x{i} {types[c]}" for i, c in enumerate(extra))

    level = whole = C.stage_chunks(docs, id_col, text_col, extra, chunk_bytes)
    bits = C.key_bits(level)
    bounds = C.bucket_bounds(C.BUCKETS_PER_TASK * C.shuffle_partitions(docs.sparkSession), bits)
    level = level.withColumn("alive", F.lit(None).cast("binary"))
    done, length = [], base_words
    while length < window:
        replies = _count_level(level, length, bits, bounds)
        step = C.stage(_next_level(level, replies, length, bits, extra, extra_schema), f"windows-{length}")
        if whole is not None:  # every document is now in the step
            C.discard(whole)
            whole = None
        done.append(step.filter("chunk IS NULL").drop("chunk", "docs", "alive"))
        level = step.filter("chunk IS NOT NULL").select("chunk", "docs", "alive")
        length *= 2
        if level.isEmpty():
            break
    else:
        # two windows of n meet by chance in about n * n / 2**wide_bits cases
        wide_bits = min(128, max(72, 2 * bits))
        wide = C.bucket_bounds(len(bounds) + 1, 64)
        replies = _first_occurrences(level, length, wide_bits, wide)
        done.append(_cut(level, replies, length, wide_bits, extra, extra_schema))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("text").alias(text_col),
                      *([F.col("sha").alias(digest)] if digest else []),
                      *[F.col(f"x{i}").alias(c) for i, c in enumerate(extra)])
