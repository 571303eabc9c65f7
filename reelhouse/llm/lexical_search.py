"""Ranked lexical search by an Aho-Corasick scan of the documents (operator 11).

No document index is built.  The items' distinct terms become one automaton whose patterns
carry a guard character on both sides; a text is lower-cased and every other character replaced
by the guard, so a pattern is met exactly where a whole term stands (two terms share the guard
between them).  Each output of the automaton is a term number, and a table maps it to the
items that hold the term, with repeats.

The documents are scanned twice and never shuffled:

1. documents with a term, terms in all, documents per item term (one row per term and task);
2. scores.  A task keeps the best k documents of each item and returns these alone.

The items are a stated query set.  They come in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_BYTES`` of text (one item at least), so an automaton and a broadcast have that bound
however many items there are; a block is one pair of scans.  All arithmetic is on whole numbers.

Defined cases: null or termless texts score nothing and do not count; null, termless or
repeated items are items of their own (the first two without rows, the others with a ranking
each); rows with equal document ids are separate documents; a null document id ranks before
all others among equal scores; a text of any length is scanned in pieces cut at guards; an empty
table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.words import slices, text_bytes

BLOCK_ITEMS = 20_000
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20    # text scanned at a time
CELLS = 1 << 21          # documents x items scored at a time
SALTS = 32               # parts in which the tasks' best documents of an item are compared first

#: Characters of a term: all but ASCII other than digits and letters.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# Byte of a text -> byte that the automaton sees: 0 is the guard.
_SEEN = np.arange(256, dtype=np.uint8)
_SEEN[[c for c in range(128) if not TERM.match(chr(c))]] = 0
_SEEN[list(_LOWER)] = list(_LOWER.values())


def terms_of(text: str | None) -> list[str]:
    return [t.translate(_LOWER) for t in TERM.findall(text or "")]


class Vocabulary:
    """The distinct terms of a block of items, and for each term the items that hold it."""

    def __init__(self, texts: list[str | None]):
        number: dict[str, int] = {}
        held = []
        for item, text in enumerate(texts):
            for term, times in Counter(terms_of(text)).items():
                held.append((number.setdefault(term, len(number)), item, times))
        held = np.array(sorted(held), dtype=np.int64).reshape(-1, 3)
        self.terms, self.n_items = list(number), len(texts)
        self.items, self.times = held[:, 1], held[:, 2]
        self.first = np.searchsorted(held[:, 0], np.arange(len(number) + 1))
        self.machine = None

    def __getstate__(self):
        return self.__dict__ | {"machine": None}

    def automaton(self) -> ahocorasick.Automaton:
        """Built once per process.  A character is a byte of UTF-8, so positions are byte positions."""
        if self.machine is None:
            self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for i, term in enumerate(self.terms):
                self.machine.add_word("\0" + term.encode().decode("latin-1") + "\0", i)
            self.machine.make_automaton()
        return self.machine

    def scan(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms per document, and (document, term, occurrences) for the block's terms."""
        data, at = text_bytes(column)
        guarded = np.insert(_SEEN[data], at, 0)          # a guard before each text and after the last
        starts = at + np.arange(len(at))
        heads = np.flatnonzero((guarded[1:] != 0) & (guarded[:-1] == 0))
        n = np.diff(np.searchsorted(heads, starts))
        guards, machine = np.flatnonzero(guarded == 0), self.automaton()
        keys, a = [np.zeros(0, dtype=np.int64)], 0
        while machine and a < len(guarded) - 1:
            b = guards[np.searchsorted(guards, min(a + SLICE_BYTES, len(guarded) - 1))]
            found = np.fromiter(machine.iter(guarded[a:b + 1].tobytes().decode("latin-1")),
                                dtype=[("end", np.int64), ("term", np.int64)])
            doc = np.searchsorted(starts, a + found["end"] - 1, side="right") - 1
            keys.append(doc * len(self.terms) + found["term"])
            a = b
        key, tf = np.unique(np.concatenate(keys), return_counts=True)
        doc, term = np.divmod(key, max(1, len(self.terms)))
        return n, doc, term, tf


def _statistics(docs: DataFrame, vocabulary: Broadcast) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, documents per term of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = vocabulary.value
        found = total = 0
        df = np.zeros(len(block.terms), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                n, _, term, _ = block.scan(part.column(1))
                found, total = found + int((n > 0).sum()), total + int(n.sum())
                df += np.bincount(term, minlength=len(df))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.concatenate([[-2, -1], held]),
                                          "n": np.concatenate([[found, total], df[held]])},
                                         schema=pa.schema([("term", pa.int64()), ("n", pa.int64())]))

    rows = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counted = {r["term"]: r["n"] for r in rows}
    df = np.zeros(len(vocabulary.value.terms), dtype=np.int64)
    for term, n in counted.items():
        if term >= 0:
            df[term] = n
    return counted.get(-2, 0), counted.get(-1, 0), df


def length_norm(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - 25 + 25 n N div L for each document length n."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        return np.array([75 + 25 * int(x) * documents // total for x in n], dtype=np.int64)
    return 75 + 25 * n * documents // total


class _Best:
    """The best k documents of each item met so far by a task."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, dtype=np.int64)
        self.rows = np.zeros((4, 0), dtype=np.int64)     # item, score, id is given, id
        self.waiting: list[np.ndarray] = []

    def add(self, scores: np.ndarray, given: np.ndarray, ids: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        if len(doc):
            self.waiting.append(np.stack([item, scores[doc, item], given[doc], ids[doc]]))
            if sum(w.shape[1] for w in self.waiting) > max(CELLS // 8, self.k * len(self.least)):
                self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate([self.rows, *self.waiting], axis=1)
        self.waiting = []
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        self.rows = rows[:, place < self.k]
        full = place == self.k - 1
        self.least[rows[0][full]] = rows[1][full]
        return self.rows


def _best_documents(docs: DataFrame, vocabulary: Broadcast, documents: int, total: int, df: np.ndarray,
                    k: int) -> DataFrame:
    """(item, doc, score): the best k documents of each item of the block, of each task."""
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = vocabulary.value
        best, many = _Best(block.n_items, k), max(1, CELLS // block.n_items)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                n, doc, term, tf = block.scan(part.column(1))
                if not len(doc):
                    continue
                share = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * length_norm(n, documents, total)[doc]))
                given = part.column(0).is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = part.column(0).fill_null(0).to_numpy()
                for a in range(0, len(n), many):
                    low, high = np.searchsorted(doc, [a, a + many])
                    if low == high:
                        continue
                    # each (document, term) once per item that holds the term
                    size = (block.first[1:] - block.first[:-1])[term[low:high]]
                    ends = np.cumsum(size)
                    post = np.arange(ends[-1]) + np.repeat(block.first[term[low:high]] - ends + size, size)
                    scores = np.zeros((min(many, len(n) - a), block.n_items), dtype=np.int64)
                    np.add.at(scores.reshape(-1),
                              np.repeat(doc[low:high] - a, size) * block.n_items + block.items[post],
                              np.repeat(share[low:high], size) * block.times[post])
                    best.add(scores, given[a:a + many], ids[a:a + many])
        item, score, given, ids = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=given == 0), pa.array(score)],
                                         names=["item", "doc", "score"])

    return docs.mapInArrow(run, "item long, doc long, score long")


def _blocks(items: DataFrame) -> Iterator[list]:
    block, size = [], 0
    for row in items.toLocalIterator():
        text = len((row[1] or "").encode())
        if block and (len(block) == BLOCK_ITEMS or size + text > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append(row)
        size += text
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item id, rank, document id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    wanted = items.select(F.col(f"`{item_id_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    id_type, out = wanted.schema["item_id"].dataType.simpleString(), None
    for block in _blocks(wanted):
        vocabulary = spark.sparkContext.broadcast(Vocabulary([r["text"] for r in block]))
        documents, total, df = _statistics(texts, vocabulary)
        best = _best_documents(texts, vocabulary, documents, total, df, k)
        order = [F.desc("score"), F.col("doc").asc_nulls_first()]
        part = Window.partitionBy("item", F.pmod(F.xxhash64("doc"), F.lit(SALTS))).orderBy(*order)
        best = best.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= k)
        whole = Window.partitionBy("item").orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
        # at most BLOCK_ITEMS ids
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"item long, item_id {id_type}")
        ranked = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc long, score long")
    return out.withColumnsRenamed({"item_id": item_id_col, "doc": id_col})


def oracle_sql() -> str:
    """DuckDB SQL of the ranking of all documents for each item, 20 places."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
    return f"""
WITH d AS (SELECT doc_id, {terms} AS terms FROM documents),
total AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS terms FROM d WHERE len(terms) > 0),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) i
      GROUP BY item_id, term),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) t
       WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * total.docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, total GROUP BY term, total.docs),
m AS (SELECT doc_id, 75 + (25 * len(d.terms) * total.docs) // total.terms AS m FROM d, total),
scored AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
      FROM scored WHERE score > 0) r
WHERE rank <= 20"""
