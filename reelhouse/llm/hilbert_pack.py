"""Packing along a space-filling curve (operator 1).

A document's token ids are hashed to a fixed number of signed counts, scaled to length
one and projected on a few fixed random directions.  The coordinates are cut to integers
and read as a point on a Hilbert curve, so documents with similar words get near keys.
Documents are range-sorted by (key, id) and their ids written one after the other along the
curve, cut every 2048 tokens.  Each task packs one range of the curve; what is left at its
end is cut at powers of two, so no sequence needs padding.

The sort key has the id in it, so a cell with very many documents is split between tasks.
Ids are encoded once, written to the shared folder and moved once.

Defined cases: null or empty text has the end id only; equal ids or repeated rows are
packed separately, ordered by their size; a long document spans as many sequences as it
needs; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.chunks import shuffle_partitions, squeeze, stage, unsqueeze
from reelhouse.llm.tokens import load

FEATURES = 512        # hashed counts per document
DIMENSIONS = 4
BITS = 10             # per dimension
KEPT_PIECES = 1_000_000
_SEED = 20_24_11


def _directions() -> np.ndarray:
    return np.random.default_rng(_SEED).standard_normal((FEATURES, DIMENSIONS))


def document_points(ids: list[np.ndarray]) -> np.ndarray:
    """Integer coordinates (documents x DIMENSIONS) of token-id lists."""
    out = np.empty((len(ids), DIMENSIONS))
    directions = _directions()
    for i, tokens in enumerate(ids):
        h = tokens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slot = (h >> np.uint64(40)) % np.uint64(FEATURES)
        counts = np.bincount(slot.astype(np.int64), weights=1.0 - 2.0 * (h >> np.uint64(63)).astype(float),
                             minlength=FEATURES)
        v = np.sign(counts) * np.log1p(np.abs(counts))
        out[i] = v @ directions / max(np.linalg.norm(v), 1e-12)
    # coordinates are about standard normal: the logistic curve spreads them evenly
    return np.minimum((1 << BITS) * (1 / (1 + np.exp(-1.7 * out))), (1 << BITS) - 1).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of integer points on the Hilbert curve of their dimension."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations from the coarsest level down
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _pack_ids(ids: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack_ids(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unsqueeze(blob), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def placed_documents(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str,
                     kept_pieces: int) -> DataFrame:
    """(key, id, n, ids): each document's place on the curve and its packed token ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = load(tokenizer, kept_pieces), np.array([end_id], dtype="<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = [np.concatenate([x, end]) for x in
                       encoder.encode_batch(part.column(1).fill_null("").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hilbert_keys(document_points(ids))), part.column(0),
                     pa.array([len(x) for x in ids], pa.int64()), pa.array([_pack_ids(x) for x in ids], pa.binary())],
                    names=["key", "id", "n", "ids"])

    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    return stage(plain.mapInArrow(run, "key long, id long, n long, ids binary"), "curve")


class Sequences:
    """Cuts a stream of documents into sequences; rows are made when a sequence is full."""

    def __init__(self, length: int, first_id: int):
        self.length, self.next_id = length, first_id
        self.open: list[tuple] = []   # (doc, start, ids, doc tokens) of the sequence being filled
        self.filled = 0
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            take = min(self.length - self.filled, len(ids) - at)
            self.open.append((doc, at, ids[at:at + take], len(ids)))
            self.filled += take
            at += take
            if self.filled == self.length:
                self._close(self.open)
                self.open, self.filled = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            raw = ids.tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(raw), total, self.next_id, offset, raw))
            offset += len(ids)
        self.next_id += 1

    def finish(self) -> None:
        """The rest, cut at the powers of two that add up to it, largest first."""
        pieces, left = self.open, self.filled
        while left:
            size = 1 << (left.bit_length() - 1)
            now, room = [], size
            while room:
                doc, start, ids, total = pieces[0]
                now.append((doc, start, ids[:room], total))
                pieces = ([(doc, start + room, ids[room:], total)] if len(ids) > room else []) + pieces[1:]
                room -= len(now[-1][2])
            self._close(now)
            left -= size
        self.open, self.filled = [], 0


COLUMNS = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("token_ids", pa.binary())])


def pack_along_curve(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048, id_col: str = "doc_id",
                     text_col: str = "text", kept_pieces: int = KEPT_PIECES) -> DataFrame:
    """One row per piece of a document: (id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, token_ids); token_ids are little-endian unsigned 32-bit.  ``kept_pieces``: the encoder's
    table, some 150 bytes a piece and task."""
    placed = placed_documents(docs, tokenizer, end_id, id_col, text_col, kept_pieces)
    order = [F.col("key"), F.col("id").asc_nulls_first(), F.col("n")]
    along = placed.repartitionByRange(shuffle_partitions(docs.sparkSession), *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sequences(length, TaskContext.get().partitionId() << 40)

        def ready():
            rows, out.rows = out.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), COLUMNS)],
                                              schema=COLUMNS)

        for batch in batches:
            for doc, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out.add(doc, _unpack_ids(blob))
                if len(out.rows) >= 4096:
                    yield ready()
        out.finish()
        if out.rows:
            yield ready()

    return (along.sortWithinPartitions(*order, "ids").select("id", "ids")
            .mapInArrow(run, "id long, start long, length long, ids_crc32 long, doc_tokens long, "
                             "sequence_id long, offset long, token_ids binary")
            .withColumnRenamed("id", id_col))
