"""Words, their hashes and the hashes of word windows, on whole Arrow batches.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``, so the cut is the
same on UTF-8 bytes as on code points.  Everything is vectorised with numpy over
the bytes of many documents; no Python object is made per word.

A word's hash is a polynomial over its bytes (modulo 2**64, each byte replaced by
a random 64-bit number), finished by a mixing step.  ``stream`` picks one of two
independent polynomials: filters use one, exact decisions use both.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
_SEED = 0x5EED_1009  # every worker must draw the same tables

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _tables(stream: int):
    rng = np.random.default_rng([_SEED, stream])
    letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    lowered = letters.copy()
    lowered[ord("A"):ord("Z") + 1] = letters[ord("a"):ord("z") + 1]
    base = int(rng.integers(0, 1 << 60)) * 8 + 5
    return letters, lowered, base, pow(base, -1, 1 << 64)


_TABLES = [_tables(0), _tables(1)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(stream: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**j and base**-j for j < n, grown on demand and kept per process."""
    have = _POWERS.get(stream)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        out = []
        for b in _TABLES[stream][2:]:
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 4 * BLOCK_BYTES:
            _POWERS[stream] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two neighbouring spans."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0x632BE59BD9B4E019)))


@dataclass
class Words:
    """Words of a run of documents: byte spans, and where each document's words lie."""

    data: np.ndarray      # uint8, the documents' bytes one after the other
    doc_bytes: np.ndarray  # n_docs + 1 offsets into data
    starts: np.ndarray    # byte span of each word
    ends: np.ndarray
    doc_words: np.ndarray  # n_docs + 1 offsets into starts

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.doc_words)

    def room(self) -> np.ndarray:
        """For each word, how many words are left in its document, itself included."""
        n = self.n_words
        return np.repeat(self.doc_words[1:], n) - np.arange(len(self.starts))

    def hashes(self, lower: bool = False, stream: int = 0) -> np.ndarray:
        table = _TABLES[stream][1 if lower else 0]
        out = np.empty(len(self.starts), dtype=np.uint64)
        a = 0
        while a < len(self.starts):
            first = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.ends, first + BLOCK_BYTES, side="right")))
            up, down = _powers(stream, int(self.ends[b - 1] - first) + 1)
            part = self.data[first:self.ends[b - 1]]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(table[part] * up[:len(part)], out=sums[1:])
            s, e = self.starts[a:b] - first, self.ends[a:b] - first
            out[a:b] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
            a = b
        return mix(out)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def words_of(column) -> Words:
    data, doc_bytes = text_bytes(column)
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, doc_bytes, none, none, np.zeros(len(doc_bytes), dtype=np.int64))
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    heads = doc_bytes[:-1][doc_bytes[:-1] < len(data)]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    tails = doc_bytes[1:] - 1
    after[tails[tails >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, doc_bytes, starts, ends, np.searchsorted(starts, doc_bytes))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive entries of ``h`` (document ends are the caller's
    business); len(h) - n + 1 values, built from windows of doubling length."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    out, have, block, size = None, 0, h, 1
    while True:
        if n & size:
            if out is None:
                out, have = block, size
            else:
                m = len(h) - have - size + 1
                out, have = combine(out[:m], block[have:have + m]), have + size
        if have == n:
            return out[:len(h) - n + 1]
        block = combine(block[:-size], block[size:])
        size *= 2


def slices(batch: pa.RecordBatch, text: int, max_bytes: int):
    """Cut a batch between documents into runs of about ``max_bytes`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    a = 0
    while a < batch.num_rows:
        done = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, done + max_bytes, side="right")))
        yield batch.slice(a, b - a)
        a = b
