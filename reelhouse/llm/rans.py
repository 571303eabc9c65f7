"""Token ids in files coded by a static range asymmetric numeral system (operator 3).

A file holds groups of blocks.  A group begins with its frequency table (scaled to
2**20), shared by all its blocks.  A block codes whole documents on LANES interleaved
64-bit states: symbol i belongs to lane i mod LANES, so a row of LANES symbols is one
vector step.  Every SEGMENT_ROWS rows a checkpoint holds the lanes' states and the place
in the word stream, so a block can be decoded from any checkpoint on its own; each block
carries a checksum of its bytes and one of its ids.  The footer lists blocks with their
place, documents and ids, and blocks are decoded independently and in parallel.

Writing is one pass: documents are range-partitioned by id, each task codes its range to
one file.  Only the ids of one group are held in memory.

Defined cases: null text is empty and has only the end id; documents come in ascending id
order, null ids first, equal ids next to each other; a document longer than a block
makes a longer block; an empty table writes no document and gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm import shared_files
from reelhouse.llm.chunks import pack_ints, shuffle_partitions, stage, unpack_ints
from reelhouse.llm.tokens import load

MAGIC = b"RLHRANS1"
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
LANES = 2048
SEGMENT_ROWS = 256
BLOCK_IDS = 1 << 20
GROUP_IDS = 1 << 23
KEPT_PIECES = 1_000_000
NO_ID = np.iinfo(np.int64).min


class Table:
    """Frequencies of the symbols that occur, scaled so that they add up to 2**SCALE_BITS."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols, self.freqs = symbols, freqs
        self.starts = np.concatenate([[0], np.cumsum(freqs)[:-1]]).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> "Table":
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        c = counts[symbols].astype(np.float64)
        freqs = 1 + np.floor(c * (((1 << SCALE_BITS) - len(c)) / c.sum())).astype(np.int64)
        freqs[np.argmax(freqs)] += (1 << SCALE_BITS) - freqs.sum()
        return cls(symbols.astype(np.int64), freqs.astype(np.uint64))

    def to_bytes(self) -> bytes:
        a, b = pack_ints(np.diff(self.symbols, prepend=0)), pack_ints(self.freqs.astype(np.int64))
        return struct.pack("<I", len(a)) + a + b

    @classmethod
    def from_bytes(cls, data: bytes) -> "Table":
        n, = struct.unpack_from("<I", data)
        return cls(np.cumsum(unpack_ints(data[4:4 + n], np.int64)), unpack_ints(data[4 + n:]))

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        freq = np.zeros(int(self.symbols[-1]) + 1, dtype=np.uint64)
        start = np.zeros_like(freq)
        freq[self.symbols], start[self.symbols] = self.freqs, self.starts
        return freq, start

    def decoder(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By slot: index of the symbol; by index: frequency and start."""
        return np.repeat(np.arange(len(self.symbols), dtype=np.int32), self.freqs.astype(np.int64)), self.freqs, self.starts


def encode_ids(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, states, places): the 32-bit word stream, and per checkpoint the lane states
    and the number of words read before it."""
    freq, start = table.encoder()
    f_all, s_all = freq[ids], start[ids]
    rows = -(-len(ids) // LANES)
    x = np.full(LANES, LOW, dtype=np.uint64)
    chunks, states = [None] * rows, []
    top, scale, half = np.uint64(63 - SCALE_BITS), np.uint64(SCALE_BITS), np.uint64(32)
    for r in range(rows - 1, -1, -1):
        f, s = f_all[r * LANES:(r + 1) * LANES], s_all[r * LANES:(r + 1) * LANES]
        v = x[:len(f)]
        full = v >= (f << top)
        chunks[r] = v[full].astype(np.uint32)
        v = np.where(full, v >> half, v)
        q = v // f
        x[:len(f)] = (q << scale) + (v - q * f) + s
        if r % SEGMENT_ROWS == 0:
            states.append(x.copy())
    words = np.concatenate(chunks) if rows else np.zeros(0, np.uint32)
    before = np.concatenate([[0], np.cumsum([len(c) for c in chunks])])[:-1] if rows else np.zeros(0)
    return words, np.array(states[::-1], dtype=np.uint64).reshape(-1, LANES), before[::SEGMENT_ROWS].astype(np.int64)


def decode_segment(words: np.ndarray, state: np.ndarray, place: int, n: int, decoder, symbols) -> np.ndarray:
    """The next ``n`` ids from a checkpoint (lane states, place in the word stream)."""
    by_slot, freqs, starts = decoder
    x, at, out = state.copy(), place, np.empty(n, dtype=np.int64)
    mask, scale, half = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    for a in range(0, n, LANES):
        v = x[:min(LANES, n - a)]
        slot = v & mask
        sym = by_slot[slot.view(np.int64)]
        out[a:a + len(v)] = sym
        v = freqs[sym] * (v >> scale) + slot - starts[sym]
        low = v < LOW
        k = int(np.count_nonzero(low))
        v[low] = (v[low] << half) | words[at:at + k]
        at += k
        x[:len(v)] = v
    return symbols[out]


def pack_block(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, table: Table) -> bytes:
    words, states, places = encode_ids(ids, table)
    parts = [pack_ints(np.diff(doc_ids, prepend=0)), pack_ints(lengths), states.astype("<u8").tobytes(),
             places.astype("<i8").tobytes(), words.astype("<u4").tobytes()]
    head = struct.pack("<QI5Q", len(ids), zlib.crc32(ids.astype("<u4").tobytes()), *map(len, parts))
    body = head + b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(data: bytes, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc ids, lengths, token ids) of a block; a damaged one raises."""
    if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("damaged block")
    n, crc, *sizes = struct.unpack_from("<QI5Q", data)
    at, parts = struct.calcsize("<QI5Q"), []
    for size in sizes:
        parts.append(data[at:at + size])
        at += size
    states = np.frombuffer(parts[2], "<u8").reshape(-1, LANES)
    places, words = np.frombuffer(parts[3], "<i8"), np.frombuffer(parts[4], "<u4").astype(np.uint64)
    decoder, step = table.decoder(), SEGMENT_ROWS * LANES
    ids = [decode_segment(words, state, int(place), min(step, n - i * step), decoder, table.symbols)
           for i, (state, place) in enumerate(zip(states, places))]
    ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("decoded ids differ from the coded ones")
    return np.cumsum(unpack_ints(parts[0], np.int64)), unpack_ints(parts[1], np.int64), ids


class FileWriter:
    """Documents in, groups of blocks out."""

    def __init__(self, out):
        self.out, self.at, self.blocks = out, 0, []
        self.docs, self.ids, self.held, self.total, self.n_docs = [], [], 0, 0, 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> tuple[int, int]:
        self.out.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= GROUP_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        lengths = np.array([len(x) for x in self.ids], dtype=np.int64)
        ids, doc_ids = np.concatenate(self.ids), np.array(self.docs, dtype=np.int64)
        table = Table.of(ids)
        where = self._put(table.to_bytes())
        ends = np.cumsum(lengths)
        a = 0
        while a < len(lengths):
            begun = int(ends[a] - lengths[a])
            b = max(a + 1, int(np.searchsorted(ends, begun + BLOCK_IDS, side="right")))
            place = self._put(pack_block(ids[begun:ends[b - 1]], doc_ids[a:b], lengths[a:b], table))
            self.blocks.append([*place, *where, self.total + begun, int(ends[b - 1]) - begun, b - a])
            a = b
        self.total += int(ends[-1])
        self.n_docs += len(lengths)
        self.docs, self.ids, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        footer = zlib.compress(json.dumps(self.blocks).encode())
        self._put(footer + struct.pack("<Q", len(footer)) + MAGIC)


def read_footer(uri: str) -> list[list[int]]:
    """Blocks of a file: [place, size, table's place, its size, ids before, ids, documents]."""
    size = shared_files.file_size(uri)
    n, magic = struct.unpack("<Q8s", shared_files.read_range(uri, size - 16, 16))
    if magic != MAGIC:
        raise ValueError(f"{uri} is not a complete file")
    return json.loads(zlib.decompress(shared_files.read_range(uri, size - 16 - n, n)))


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Code every document's ids and the end id into ``folder``; one row (part, path, n_docs,
    n_ids) per file, in document order over the parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.rans"
        encoder, end = load(tokenizer, KEPT_PIECES), np.array([end_id], dtype="<u4")
        with shared_files.whole_file(path) as out:
            writer = FileWriter(out)
            for batch in batches:
                ids = batch.column(0).fill_null(NO_ID).to_numpy()
                texts = batch.column(1).fill_null("").to_pylist()
                for doc_id, tokens in zip(ids, encoder.encode_batch(texts)):
                    writer.add(doc_id, np.concatenate([tokens, end]))
            writer.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "n_docs": [writer.n_docs],
                                          "n_ids": [writer.total]})

    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    parts = (plain.repartitionByRange(shuffle_partitions(docs.sparkSession), *order[:2])
             .sortWithinPartitions(*order))
    return stage(parts.mapInArrow(run, "part long, path string, n_docs long, n_ids long"), "rans-files")


def read_ids(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, token_ids) per document, decoded from the files: block
    by block, each where Spark puts it.  Without ``with_ids`` the ids end in the task."""
    spark = files.sparkSession
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    files = files.withColumn("before", before)  # one row per file

    def blocks(frames):
        for pdf in frames:
            rows = [(path, base + b[4], *b[:4]) for path, base in zip(pdf["path"], pdf["before"])
                    for b in read_footer(path)]
            yield pd.DataFrame(rows, columns=["path", "first", "place", "size", "table_place", "table_size"])

    def decode(frames):
        tables: dict[tuple, Table] = {}
        for pdf in frames:
            for r in pdf.itertuples():
                key = (r.path, r.table_place)
                if key not in tables:
                    tables = {key: Table.from_bytes(shared_files.read_range(r.path, r.table_place, r.table_size))}
                doc_ids, lengths, ids = unpack_block(shared_files.read_range(r.path, r.place, r.size), tables[key])
                starts = np.concatenate([[0], np.cumsum(lengths)])
                raw = ids.astype("<u4").tobytes()
                cut = [raw[4 * a:4 * b] for a, b in zip(starts, starts[1:])]
                out = {"id": pd.array([None if d == NO_ID else d for d in doc_ids], dtype="Int64"),
                       "start": r.first + starts[:-1], "n_tokens": lengths, "ids_crc32": [zlib.crc32(c) for c in cut]}
                yield pd.DataFrame(out | ({"token_ids": cut} if with_ids else {}))

    found = files.mapInPandas(blocks, "path string, first long, place long, size long, "
                                      "table_place long, table_size long")
    return (found.repartition(2 * shuffle_partitions(spark))
            .mapInPandas(decode, "id long, start long, n_tokens long, ids_crc32 long"
                         + ", token_ids binary" * with_ids))
