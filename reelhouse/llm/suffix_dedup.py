"""Suffix-array dedup by threshold-bounded interval expansion (operator 12).

Every byte covered by a ``length``-byte string that also starts anywhere else goes.  Which
strings repeat is read off Burrows-Wheeler transforms, whose intervals are extended backwards
breadth first until the common prefixes reach ``length`` (``intervals``).  One transform
of the corpus fits no task; what follows deals the text out so that equal strings meet.

1. A *window* is the ``length`` bytes from a position.  Its *anchor* is the smallest hash of the
   grams inside it, the leftmost if several: equal windows have equal anchors at equal offsets.
   Neighbouring windows with the same anchor form a *run*, one string of the text.
2. Text that cannot repeat leaves early.  Windows of a run are taken in blocks aligned on the
   anchor, of 32, then of 4 positions; all windows of a block share a core of bytes, so
   where the core's hash is unique in the corpus, none of them repeats (``chunks`` counts
   the hashes).  Documents without a surviving window are done.
3. Equal runs of the corpus are one string with its number.  Where an anchor has one string only,
   no interval can hold another: its windows repeat if it stands more than once.  The
   others' bytes are sent once each, by the first chunk that holds them.
4. Strings meet by anchor.  A group of anchors of about ``BATCH_BYTES`` is transformed and
   expanded; a window repeats if its interval holds another suffix, or its string stands more than
   once.  All chunks that hold a string are answered which of its positions repeat, and
   cut what these cover.

Copies cost one entry per chunk, not one per copy, and are never gathered.  What has one
anchor is bounded by its different surroundings, of which the blocks of 4 leave at most three
bytes beyond what repeats.

Defined cases: null text counts as empty; a text shorter than ``length`` never changes; ids may
be null or repeat, each row is a text of its own; matches never cross texts; an empty table gives
an empty result; other columns are ignored unless named in ``carry``.  Cuts fall between bytes,
also inside a character, so what is kept is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import chunks as C
from reelhouse.llm import words as W
from reelhouse.llm.intervals import repeated_starts

BLOCKS = (32, 4)
GRAM = 16
PIECE_BYTES = 1 << 18     # text hashed at a time
BATCH_BYTES = 1 << 20     # strings transformed together, more only if they share one anchor
RESULT_BYTES = 1 << 20    # text per returned batch
SPREAD = np.uint64(0x9E3779B97F4A7C15)
_POS = np.uint64((1 << 20) - 1)


class _Spans:
    """Hashes of spans of up to PIECE_BYTES + length bytes: a polynomial over the bytes, in
    one of two independent streams."""

    def __init__(self, part: np.ndarray, stream: int):
        up, self.down = W._powers(stream, len(part) + 1)
        self.sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(W._TABLES[stream][0][part] * up[:len(part)], out=self.sums[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]


def _anchors(spans: _Spans, n: int, length: int, gram: int) -> np.ndarray:
    """Where the anchor of each window of a part of ``n`` bytes is."""
    n_grams, wide, n_windows = n - gram + 1, length - gram + 1, n - length + 1
    key = (spans.sums[gram:] - spans.sums[:n_grams]) * spans.down[:n_grams] * SPREAD
    key &= ~_POS
    key |= np.arange(n_grams, dtype=np.uint64)
    padded = np.full(-(-n_grams // wide) * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n_grams] = key
    rows = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:n_windows], ahead[wide - 1:wide - 1 + n_windows])
    least &= _POS
    return least.view(np.int64)


class _Text:
    """The bytes of a chunk's texts and the windows in question."""

    def __init__(self, table: pa.Table, length: int, alive: bytes | None = None):
        self.data, self.at = W.text_bytes(table["_text"])
        self.length, self.gram = length, min(GRAM, max(1, length // 2))
        self.mask, self.cut_down = np.zeros(len(self.data), dtype=bool), alive is not None
        if alive is None:
            for a, b in zip(self.at[:-1], self.at[1:] - length + 1):
                self.mask[a:max(a, b)] = True
        else:
            edge = np.cumsum(C.unpack_ints(alive, np.int64))
            for a, b in zip(edge[::2], edge[1::2]):
                self.mask[a:b] = True

    def pieces(self) -> Iterator[tuple]:
        """(place, part, spans, windows, anchors) of each piece of the bytes that windows in question
        cover; ``place`` maps positions of the part, as windows and anchors are, to the text."""
        data, mask, place = self.data, self.mask, None
        if self.cut_down:
            edge = np.flatnonzero(np.diff(np.concatenate([[False], self.mask, [False]]).astype(np.int8)))
            cover = np.zeros(len(self.data) + 1, dtype=np.int32)
            np.add.at(cover, edge[::2], 1)
            np.add.at(cover, edge[1::2] + self.length - 1, -1)
            place = np.flatnonzero(np.cumsum(cover[:-1]))
            data, mask = self.data[place], self.mask[place]
        for a in range(0, len(data), PIECE_BYTES):
            at = np.flatnonzero(mask[a:a + PIECE_BYTES])
            if len(at):
                part = data[a:a + PIECE_BYTES + self.length - 1]
                spans = _Spans(part, 0)
                where = _anchors(spans, len(part), self.length, self.gram)
                yield (np.arange(a, a + len(part)) if place is None else place[a:]), part, spans, at, where[at]

    def cores(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and core hash of each block."""
        out = []
        for place, _, spans, at, where in self.pieces():
            core = where - ((where - at) & -block)   # blocks are powers of two
            head = np.flatnonzero(_changes(core) | _gaps(place[at]))
            out.append((place[at[head]], np.diff(head, append=len(at)),
                        W.mix(spans.of(core[head], self.length - block + 1))))
        return _joined(out, [np.int64, np.int64, np.uint64])

    def runs(self) -> tuple[np.ndarray, ...]:
        """First window, number of windows, two hashes of the bytes and the anchor's hash of each run."""
        out = []
        for place, part, spans, at, where in self.pieces():
            head = np.flatnonzero(_changes(where) | _gaps(place[at]))
            n = np.diff(head, append=len(at))
            size, second = n + self.length - 1, _Spans(part, 1)
            keys = [W.mix(s.of(at[head], size) + size.astype(np.uint64)) for s in (spans, second)]
            out.append((place[at[head]], n, *keys, W.mix(spans.of(where[head], self.gram) * SPREAD)))
        return _joined(out, [np.int64, np.int64] + [np.uint64] * 3)


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _gaps(at: np.ndarray) -> np.ndarray:
    new = np.ones(len(at), dtype=bool)
    new[1:] = np.diff(at) != 1
    return new


def _joined(parts: list[tuple], types: list) -> tuple[np.ndarray, ...]:
    if not parts:
        return tuple(np.zeros(0, dtype=t) for t in types)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _packed_mask(mask: np.ndarray) -> bytes:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return C.pack_ints(np.diff(edge, prepend=0).astype(np.int64))


def _count(level: DataFrame, length: int, block: int, bits: int, bounds: np.ndarray) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, keys = _Text(C.unpack_table(row["docs"]), length, row["alive"]).cores(block)
                found = list(C.count_blobs(keys >> np.uint64(64 - bits), bounds))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [row["chunk"]] * len(found), "bucket": [f[0] for f in found],
                     "keys": [f[1] for f in found], "counts": [f[2] for f in found]},
                    schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()),
                                      ("keys", pa.binary()), ("counts", pa.binary())]))

    return C.answers(level.select("chunk", "docs", "alive").mapInArrow(
        emit, "chunk long, bucket int, keys binary, counts binary"))


def _result_batches(table: pa.Table, text: _Text, gone: np.ndarray | None, extra: list[str],
                    pick: np.ndarray | None = None) -> Iterator[dict]:
    """Columns of the result rows of the texts ``pick`` (all by default), a slice at a time."""
    if pick is None:
        pick = np.arange(len(table))
    sizes = np.cumsum((text.at[1:] - text.at[:-1])[pick])
    a = 0
    while a < len(pick):
        b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + RESULT_BYTES, side="right")))
        part, kept, removed, spans = pick[a:b], [], [], []
        for d in part:
            x, y = text.at[d], text.at[d + 1]
            cut = None if gone is None else gone[x:y]
            if cut is None or not cut.any():
                kept.append(text.data[x:y].tobytes())
                removed.append(0)
                spans.append(0)
            else:
                kept.append(text.data[x:y][~cut].tobytes())
                removed.append(int(cut.sum()))
                spans.append(int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum()))
        rows = table.take(part)
        yield {"id": rows["_id"].combine_chunks(), "n_bytes": pa.array(text.at[part + 1] - text.at[part]),
               "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
               "kept": pa.array(kept, pa.binary())} | {
                   f"x{i}": rows[f"c{i}"].combine_chunks() for i in range(len(extra))}
        a = b


def _next_level(level: DataFrame, replies: DataFrame, length: int, block: int, bits: int, extra: list[str],
                result: str) -> DataFrame:
    """Rows of the documents that are done (chunk null), and the chunks cut down to the others."""
    def run(row: dict, reply: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = C.unpack_table(row["docs"])
        text = _Text(table, length, row["alive"])
        first, n, keys = text.cores(block)
        on = C.totals(reply, keys >> np.uint64(64 - bits)) > 1
        mask = np.zeros(len(text.data), dtype=bool)
        for a, b in zip(first[on], (first + n)[on]):
            mask[a:b] = True
        any_before = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        going = any_before[text.at[1:]] > any_before[text.at[:-1]]
        for columns in _result_batches(table, text, None, extra, np.flatnonzero(~going)):
            rows = len(columns["id"])
            yield pa.RecordBatch.from_pydict({"chunk": pa.nulls(rows, pa.int64()), "docs": pa.nulls(rows, pa.binary()),
                                              "alive": pa.nulls(rows, pa.binary())} | columns)
        if going.any():
            inside = np.repeat(going, np.diff(text.at))
            one = {"chunk": pa.array([row["chunk"]], pa.int64()),
                   "docs": pa.array([C.pack_table(table.filter(pa.array(going)))], pa.binary()),
                   "alive": pa.array([_packed_mask(mask[inside])], pa.binary()),
                   **{c: pa.nulls(1, pa.int64()) for c in ("id", "n_bytes", "n_removed", "n_spans")},
                   "kept": pa.nulls(1, pa.binary()),
                   **{f"x{i}": pa.nulls(1, table[f"c{i}"].type) for i in range(len(extra))}}
            yield pa.RecordBatch.from_pydict(one)

    return C.meet(level, replies, ["docs", "alive"], run, "chunk long, docs binary, alive binary, " + result)


class _DistinctRuns:
    """The different runs of a chunk, by bucket."""

    def __init__(self, row: dict, length: int, n_buckets: int):
        self.text = _Text(C.unpack_table(row["docs"]), length, row["alive"])
        first, n, high, low, anchor = self.text.runs()
        bucket = ((anchor >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
        order = np.lexsort((low, high, anchor))   # buckets ascend with the anchor
        new = _changes(anchor[order], high[order], low[order])
        head = order[new]
        #: of every run of the chunk, in this order: first window, and which different run it is
        self.starts, self.which = first[order], np.cumsum(new) - 1
        self.first, self.n, self.high, self.low, self.anchor = first[head], n[head], high[head], low[head], anchor[head]
        self.times = np.diff(np.flatnonzero(new), append=len(order))
        cuts = np.searchsorted(bucket[head], np.arange(n_buckets + 1))
        self.parts = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]

    def ids(self, parts: list[tuple]) -> dict[str, list[bytes]]:
        return {"high": [C.pack_ints(self.high[a:b]) for _, a, b in parts],
                "low": [C.pack_ints(self.low[a:b]) for _, a, b in parts],
                "anchors": [C.pack_sorted(self.anchor[a:b]) for _, a, b in parts]}


# What a chunk learns of a run: another chunk sends it, send it (it stands once, more often), or
# its anchor has no other (it stands once, more often).
ELSEWHERE, ONCE, OFTEN, ALONE_ONCE, ALONE_OFTEN = range(5)
_IDS = [("high", pa.binary()), ("low", pa.binary()), ("anchors", pa.binary())]


def _elect(level: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """For each chunk and different run of it, one byte: what to do with it."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                r = _DistinctRuns(row, length, n_buckets)
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [row["chunk"]] * len(r.parts), "bucket": [i for i, _, _ in r.parts]}
                    | r.ids(r.parts) | {"often": [C.squeeze((r.times[a:b] > 1).tobytes()) for _, a, b in r.parts]},
                    schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), *_IDS, ("often", pa.binary())]))

    def run(pdf):
        import pandas as pd

        high, low, anchor, sizes = _ids(pdf)
        often = np.concatenate([np.frombuffer(C.unsqueeze(b), dtype=bool) for b in pdf["often"]])
        chunk = np.repeat(pdf["chunk"].to_numpy(), sizes)
        order = np.lexsort((chunk, low, high, anchor))
        new = _changes(anchor[order], high[order], low[order])
        group = np.cumsum(new) - 1
        more = np.bincount(group, weights=1 + often[order]) > 1
        family = np.cumsum(_changes(anchor[order[new]])) - 1   # of each group
        alone = np.bincount(family)[family] == 1
        code = np.zeros(len(order), dtype=np.uint8)
        code[order[new]] = np.where(more, OFTEN, ONCE)
        code[order[alone[group]]] = np.where(more, ALONE_OFTEN, ALONE_ONCE)[group[alone[group]]]
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"],
                             "reply": [C.squeeze(p.tobytes()) for p in np.split(code, np.cumsum(sizes)[:-1])]})

    blobs = level.select("chunk", "docs", "alive").mapInArrow(
        emit, "chunk long, bucket int, high binary, low binary, anchors binary, often binary")
    return blobs.groupBy("bucket").applyInPandas(run, "chunk long, bucket int, reply binary")


def _ids(pdf) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    anchors = [C.unpack_sorted(b) for b in pdf["anchors"]]
    return (np.concatenate([C.unpack_ints(b) for b in pdf["high"]]), np.concatenate([C.unpack_ints(b) for b in pdf["low"]]),
            np.concatenate(anchors), [len(a) for a in anchors])


def _repeats(level: DataFrame, elected: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """For each chunk and different run of it, which of its windows repeat: number of stretches of
    each run, then their ends."""
    def emit(row: dict, reply: list[bytes]) -> Iterator[pa.RecordBatch]:
        r = _DistinctRuns(row, length, n_buckets)
        for part, blob in zip(r.parts, reply, strict=True):
            i, a, b = part
            code = np.frombuffer(C.unsqueeze(blob), dtype=np.uint8)
            sent = a + np.flatnonzero((code == ONCE) | (code == OFTEN))
            body = b"".join(r.text.data[s:s + n + length - 1].tobytes() for s, n in zip(r.first[sent], r.n[sent]))
            yield pa.RecordBatch.from_pydict(
                {"chunk": [row["chunk"]], "bucket": [i]} | r.ids([part])
                | {"code": [blob], "n": [C.pack_ints(r.n[a:b][code != ELSEWHERE])], "body": [C.squeeze(body)]},
                schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), *_IDS]
                                 + [(c, pa.binary()) for c in ("code", "n", "body")]))

    def run(pdf):
        import pandas as pd

        high, low, anchor, sizes = _ids(pdf)
        order = np.lexsort((low, high, anchor))
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(_changes(anchor[order], high[order], low[order])) - 1
        code = np.concatenate([np.frombuffer(C.unsqueeze(b), dtype=np.uint8) for b in pdf["code"]])
        n = np.zeros(len(code), dtype=np.int64)
        n[code != ELSEWHERE] = np.concatenate([C.unpack_ints(b, np.int64) for b in pdf["n"]])
        stretches: list = [()] * (int(group.max()) + 1)
        for k in np.flatnonzero(code == ALONE_OFTEN):
            stretches[group[k]] = (0, n[k])
        sent = np.flatnonzero((code == ONCE) | (code == OFTEN))
        bodies, ends = b"".join(C.unsqueeze(b) for b in pdf["body"]), np.cumsum(n[sent] + length - 1)
        by_anchor = np.argsort(anchor[sent], kind="stable")
        weight = np.cumsum((n[sent] + length)[by_anchor])
        # a batch takes whole anchors
        last = np.append(np.flatnonzero(_changes(anchor[sent[by_anchor]]))[1:], len(sent))
        a = 0
        while a < len(by_anchor):
            reach = np.searchsorted(weight, (weight[a - 1] if a else 0) + BATCH_BYTES, side="right")
            b = int(last[max(np.searchsorted(last, reach, side="right") - 1, np.searchsorted(last, a, side="right"))])
            some = by_anchor[a:b]
            strings = [bodies[ends[k] - n[sent[k]] - length + 1:ends[k]] for k in some]
            for k, mask in zip(sent[some], repeated_starts(strings, length)):
                if code[k] == OFTEN:
                    mask[:] = True
                stretches[group[k]] = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            a = b
        count = np.array([len(x) // 2 for x in stretches], dtype=np.int64)
        flat = np.concatenate(stretches).astype(np.int64)
        first = np.cumsum(2 * count) - 2 * count
        replies = []
        for g in np.split(group, np.cumsum(sizes)[:-1]):
            size = 2 * count[g]
            pick = np.arange(size.sum()) + np.repeat(first[g] - np.cumsum(size) + size, size)
            replies.append(C.pack_ints(np.concatenate([count[g], flat[pick]])))
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "reply": replies})

    blobs = C.meet(level, elected, ["docs", "alive"], emit,
                   "chunk long, bucket int, high binary, low binary, anchors binary, code binary, n binary, body binary")
    # a fixed number: bytes are few for the work they make, so buckets are not to be joined by bytes
    blobs = blobs.repartition(C.shuffle_partitions(level.sparkSession), "bucket")
    return blobs.groupBy("bucket").applyInPandas(run, "chunk long, bucket int, reply binary")


def _cut(level: DataFrame, replies: DataFrame, length: int, n_buckets: int, extra: list[str], result: str) -> DataFrame:
    def run(row: dict, reply: list[bytes]) -> Iterator[pa.RecordBatch]:
        r = _DistinctRuns(row, length, n_buckets)
        edge = np.zeros(len(r.text.data) + 1, dtype=np.int64)
        for (_, a, b), blob in zip(r.parts, reply, strict=True):
            values = C.unpack_ints(blob, np.int64)
            count, ends = values[:b - a], values[b - a:].reshape(-1, 2)
            first = np.cumsum(count) - count
            x, y = np.searchsorted(r.which, [a, b])
            which = r.which[x:y] - a
            pick = np.arange(count[which].sum()) + np.repeat(first[which] - np.cumsum(count[which]) + count[which], count[which])
            start = np.repeat(r.starts[x:y], count[which])
            np.add.at(edge, start + ends[pick, 0], 1)
            np.add.at(edge, start + ends[pick, 1] + length - 1, -1)
        table = C.unpack_table(row["docs"])
        for columns in _result_batches(table, r.text, np.cumsum(edge[:-1]) > 0, extra):
            yield pa.RecordBatch.from_pydict(columns)

    return C.meet(level, replies, ["docs", "alive"], run, result)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                          carry: list[str] | None = None, chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, carried columns) per document; see the module."""
    extra = list(carry or [])
    out_names = [id_col, "n_bytes", "n_removed", "n_spans", "kept"]
    if set(extra) & set(out_names):
        raise ValueError(f"carried columns clash with the result's: {sorted(set(extra) & set(out_names))}")
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    result = ("id long, n_bytes long, n_removed long, n_spans long, kept binary"
              + "".join(f", x{i} {types[c]}" for i, c in enumerate(extra)))

    chunks = C.stage_chunks(docs, id_col, text_col, extra, chunk_bytes)
    bits = C.key_bits(chunks)
    bounds = C.bucket_bounds(C.BUCKETS_PER_TASK * C.shuffle_partitions(docs.sparkSession), bits)
    level, done, read = chunks.withColumn("alive", F.lit(None).cast("binary")), [], chunks
    for block in BLOCKS:
        if block > length:
            continue
        replies = _count(level, length, block, bits, bounds)
        step = C.stage(_next_level(level, replies, length, block, bits, extra, result), f"blocks-{block}")
        if read is chunks:   # every document is now in the step
            C.discard(chunks)
        done.append(step.filter("chunk IS NULL").drop("chunk", "docs", "alive"))
        read, level = step, step.filter("chunk IS NOT NULL").select("chunk", "docs", "alive")
    n_buckets = len(bounds) + 1
    repeats = _repeats(level, _elect(level, length, n_buckets), length, n_buckets)
    out = _cut(level, repeats, length, n_buckets, extra, result)
    for part in done:
        out = out.unionByName(part)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept",
                      *[F.col(f"x{i}").alias(c) for i, c in enumerate(extra)])


def oracle_sql() -> str:
    """DuckDB SQL over the hexadecimal form of each text's bytes, windows of 400 bytes."""
    return """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS body FROM documents),
win AS (SELECT doc_id, pos, md5(substr(body, 2 * pos + 1, 800)) AS word
        FROM (SELECT doc_id, body, unnest(range(greatest(len(body) // 2 - 399, 0))) AS pos FROM d) x),
twice AS (SELECT word FROM win GROUP BY word HAVING count(*) > 1),
found AS (SELECT doc_id, pos FROM win SEMI JOIN twice USING (word)),
head AS (SELECT doc_id, pos, coalesce(pos > lag(pos) OVER w + 400, true) AS new FROM found WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
span AS (SELECT doc_id, min(pos) AS a, max(pos) + 400 AS b FROM (SELECT doc_id, pos, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS k
         FROM head) y GROUP BY doc_id, k),
gap AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS x, a AS y FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY a)
        UNION ALL SELECT d.doc_id, coalesce(max(span.b), 0), any_value(len(d.body)) // 2 FROM d LEFT JOIN span ON span.doc_id = d.doc_id GROUP BY d.doc_id),
kept AS (SELECT gap.doc_id, string_agg(substr(body, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS body
         FROM gap JOIN d ON d.doc_id = gap.doc_id GROUP BY gap.doc_id),
gone AS (SELECT doc_id, sum(b - a) AS n, count(*) AS spans FROM span GROUP BY doc_id)
SELECT d.doc_id, (len(d.body) // 2)::BIGINT AS n_bytes, coalesce(gone.n, 0)::BIGINT AS n_removed,
       coalesce(gone.spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.body)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN gone ON gone.doc_id = d.doc_id"""
