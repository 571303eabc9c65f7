"""BPE encoding and decoding of long texts by tree concatenation (operator 2).

A text longer than a leaf is cut in halves, these again, down to leaves; leaves are rows
of their own and are encoded in parallel wherever Spark puts them.  Neighbours are then
joined up the tree.  At a join, a window around it is encoded again and grows until both
sides agree exactly:

* the library cuts text into pieces by a pattern before it merges.  Between certain
  neighbouring characters every cut of every text has a piece border (a blank after
  something else, a letter next to a digit, a mark after either, a digit after a mark).  A window
  from such a border left of the join to one right of it has the ids that the whole text has there;
* inside one long run of letters there is no such border.  There the window is a number of
  tokens on either side: if its new ids begin with the left side's token and end with
  the right side's, every pair of neighbours in the joined list is one that the merges
  produce, and then the list is the encoding.

A window that reaches both ends is the plain encoding of the joined text, so the result is
always the library's.

Defined cases: null or empty text has no ids and decodes to the empty text; a text that
contains a special token's string is encoded in one piece, as the library does; repeated
ids stay separate rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reelhouse.llm.chunks import shuffle_partitions, squeeze, unsqueeze
from reelhouse.llm.tokens import _L, _N, byte_letters, load
from reelhouse.llm.words import slices

LEAF_CHARS = 16384
SLICE_BYTES = 4 << 20   # text encoded at a time
KEPT_PIECES = 300_000
FIRST_WINDOW = 64
_P = r"!-/:-@\[-`{-~"
_BORDER = re.compile(rf"(?<=[{_L}{_N}{_P}])(?=[ \t\n\r])|(?<=[{_L}])(?=[{_N}])|(?<=[{_N}])(?=[{_L}])"
                     rf"|(?<=[{_L}{_N}])(?=[{_P}])|(?<=[{_P}])(?=[{_N}])")
_LETTERS = re.compile(rf"[{_L}]{{16,}}")

_VOCABULARIES: dict[str, "Vocabulary"] = {}


def vocabulary(path: str) -> "Vocabulary":
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


class Vocabulary:
    """The bytes of each id of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        found = {i: b"".join(byte[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        found |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.tokens = [found.get(i, b"") for i in range(max(found) + 1)]
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)

    def text(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def leaves(text: str, size: int) -> list[str]:
    """Halves of halves of a text, each of at most ``size`` characters, in order."""
    parts = 1
    while -(-len(text) // parts) > size:
        parts *= 2
    return [text[len(text) * i // parts:len(text) * (i + 1) // parts] for i in range(parts)]


def _aligned(data: bytes, a: int, b: int) -> tuple[int, int]:
    """Shrink data[a:b] to whole characters."""
    while a < b and data[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(data) and data[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def _tokens_before(ends: np.ndarray, place: int) -> int | None:
    """How many tokens end at or before ``place``, if one ends (or the text begins) there."""
    k = int(np.searchsorted(ends, place, side="right"))
    return k if place == (ends[k - 1] if k else 0) else None


def join(left: np.ndarray, right: np.ndarray, encode, vocab: Vocabulary) -> np.ndarray:
    """Ids of the text of ``left`` followed by that of ``right``."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    l_ends, r_ends = np.cumsum(vocab.lengths[left]), np.cumsum(vocab.lengths[right])
    l_text, r_text = vocab.text(left), vocab.text(right)
    w = FIRST_WINDOW
    while True:
        all_left, all_right = w >= len(l_text), w >= len(r_text)
        a, a_end = _aligned(l_text, max(0, len(l_text) - w), len(l_text))
        b_start, b = _aligned(r_text, 0, min(w, len(r_text)))
        near_left, near_right = l_text[a:a_end].decode(), r_text[b_start:b].decode()
        borders = [m.start() for m in _BORDER.finditer(near_left)]
        border = _BORDER.search(near_right)
        from_ = len(l_text) - len(near_left[borders[-1]:].encode()) if borders else 0 if all_left else None
        to = len(near_right[:border.start()].encode()) if border else len(r_text) if all_right else None
        if from_ is not None and to is not None:
            i, j = _tokens_before(l_ends, from_), _tokens_before(r_ends, to)
            if i is not None and j is not None:
                middle = encode((l_text[from_:] + r_text[:to]).decode())
                return np.concatenate([left[:i], middle, right[j:]])
        i = int(np.searchsorted(l_ends, len(l_text) - w))
        j = int(np.searchsorted(r_ends, w)) + 1
        if 0 < i < len(left) and j < len(right):
            try:
                window = (vocab.text(left[i:]) + vocab.text(right[:j])).decode()
            except UnicodeDecodeError:  # a token ends inside a character: take a larger window
                window = ""
            if len(vocab.text(left[i:])) >= 16 and _LETTERS.fullmatch(window):
                middle = encode(window)
                if middle[0] == left[i] and middle[-1] == right[j - 1]:
                    return np.concatenate([left[:i], middle, right[j:]])
        if all_left and all_right:  # every border misses the tokens: encode the whole
            return encode((l_text + r_text).decode())
        w *= 2


def join_all(parts: list[np.ndarray], encode, vocab: Vocabulary) -> np.ndarray:
    while len(parts) > 1:
        parts = [join(parts[i], parts[i + 1], encode, vocab) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def _pack(ids: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unsqueeze(blob), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def decoded(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of token ids, special tokens included; bytes that are no UTF-8 become U+FFFD, as
    the library's decode has them."""
    return vocab.text(ids).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     leaf_chars: int = LEAF_CHARS, decode: bool = False) -> DataFrame:
    """(id, token_ids): the ids of every document as an array; with ``decode`` also the text decoded
    from them, in the same pass."""
    fields = "token_ids array<int>" + (f", `{text_col}` string" if decode else "")
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    special = reduce(or_, [F.contains(F.lower("text"), F.lit(s)) for s in load(tokenizer, KEPT_PIECES).specials], F.lit(False))
    cut = (F.length("text") > leaf_chars) & ~special
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("leaf", pa.int32()), ("text", pa.string())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                out = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    out += [(row, doc, i, p) for i, p in enumerate(leaves(text, leaf_chars))]
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def encode(batches: Iterator[pa.RecordBatch], outputs) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer, KEPT_PIECES)
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "text"]
            for part in slices(batch, batch.schema.names.index("text"), SLICE_BYTES):
                ids = encoder.encode_batch(part.column("text").to_pylist())
                columns = [part.column(c) for c in kept] + outputs(ids)
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "token_ids", text_col][:len(columns)])

    def whole(ids: list[np.ndarray]) -> list[pa.Array]:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        out = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32)))]
        return out + [pa.array([decoded(x, vocabulary(tokenizer)) for x in ids], pa.string())] * decode

    def packed(ids: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array([_pack(x) for x in ids], pa.binary())]

    def join_leaves(pdf: pd.DataFrame) -> pd.DataFrame:
        encoder, vocab = load(tokenizer, KEPT_PIECES), vocabulary(tokenizer)
        parts = [_unpack(b) for b in pdf.sort_values("leaf")["token_ids"]]
        ids = join_all(parts, lambda text: encoder.encode_batch([text])[0], vocab)
        row = pd.DataFrame({"id": pdf["id"].iloc[:1].astype("Int64"), "token_ids": [ids.astype(np.int32)]})
        return row.assign(**{text_col: [decoded(ids, vocab)]}) if decode else row

    short = plain.filter(~cut).mapInArrow(lambda it: encode(it, whole), f"id long, {fields}")
    long = (plain.filter(cut).mapInArrow(split, "row long, id long, leaf int, text string")
            .repartition(shuffle_partitions(docs.sparkSession), "row", "leaf")
            .mapInArrow(lambda it: encode(it, packed), "row long, id long, leaf int, token_ids binary")
            .groupBy("row").applyInPandas(join_leaves, f"id long, {fields}"))
    return short.unionByName(long).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``encoded`` (with a column token_ids) and the decoded text; null ids decode to the empty text."""
    @F.pandas_udf(StringType())
    def decode(ids: pd.Series) -> pd.Series:
        vocab = vocabulary(tokenizer)
        return ids.map(lambda x: decoded(np.asarray(x), vocab))

    return encoded.withColumn(text_col, decode(F.coalesce("token_ids", F.array().cast("array<int>"))))
