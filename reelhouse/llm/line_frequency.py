"""Quality rules by line frequency across documents (operator 8).

Base: a document of fewer than ``min_words`` words, or more than half of whose words stand in
three-word windows that the text repeats, fails.

Method: lines are normalised (lower case, blanks to one) and hashed to 128 bits.  For each host the
distinct documents that have a line are counted.  A line in more than ``max_share`` percent
of its host's documents, and in ``min_docs`` at least, is furniture: it is removed.  A document that
loses more than ``max_removed`` percent of its words is depleted and rejected.

Documents are rows, so exact copies count each, unless ``copies_once``: then the documents of a host are
its different texts, in a line's count and in the host's total alike.  ``keep_good`` counts so,
because copies would else push their own lines over the limit and all of them be rejected.

Each (host, line, document) is one small row; counts are partial sums, so a line in a third of
all documents costs one row per task.  Texts move only when cleaned texts are asked for.

Defined cases: null text has no words and fails the base; a null host is a host of its own; rows with
equal ids are separate documents; lines without a word are neither counted nor removed; a table
without rows gives none; input columns named in ``carry`` come along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.chunks import free_name, stage
from reelhouse.llm.words import Words, combine, slices, window_hashes, words_of

MIN_WORDS, MAX_REPEATED, MAX_SHARE, MIN_DOCS, MAX_REMOVED = 50, 50, 10, 10, 50
SYMBOLS = b"#*$%&|<>"   # fixed value: the characters counted as symbols
BLANKS = " \t\n\x0b\f\r"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
SLICE_BYTES = 2 << 20


def _per_doc(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_window_words(words: Words, size: int = 3) -> np.ndarray:
    """Per document, its words in windows of ``size`` words that it has twice or more."""
    at = np.flatnonzero(words.room() >= size)
    doc = np.repeat(np.arange(len(words.n_words)), words.n_words)[at]
    key = combine(window_hashes(words.hashes(), size)[at], doc.astype(np.uint64))
    _, group, count = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words.starts) + 1, dtype=np.int64)
    many = at[count[group] > 1]
    np.add.at(edge, many, 1)
    np.add.at(edge, many + size, -1)
    return _per_doc(np.cumsum(edge[:-1]) > 0, words.doc_words)


def line_key(line: str) -> tuple[int, int] | None:
    """(hash, words) of a line: 128 bits as bytes, or None for a line without a word."""
    words = line.lower().encode().split()
    return (xxhash.xxh3_128_digest(b" ".join(words)), len(words)) if words else None


def text_lines(text: str) -> tuple[int, dict[bytes, int]]:
    """(lines equal to an earlier one, {line hash: words in all lines with it})."""
    seen, repeated, found = set(), 0, {}
    for line in text.split("\n"):
        key = line_key(line)
        if key:
            repeated += line in seen
            seen.add(line)
            found[key[0]] = found.get(key[0], 0) + key[1]
    return repeated, found


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("host", pa.string()), ("text", pa.binary()), *((c, pa.int64()) for c in STATS),
                     ("lines", pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())])))])


def document_statistics(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(row, id, host, 128-bit hash of the text, statistics, lines) per document, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                words = words_of(part.column(2))
                inside = np.zeros(len(words.data) + 1, dtype=np.int8)
                inside[words.starts] += 1
                inside[words.ends] -= 1  # a word may begin where another document's ends
                letters = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((words.data & 0xC0) != 0x80)
                texts = part.column(2).fill_null("").to_pylist()
                lines = [text_lines(t) for t in texts]
                stats = [words.n_words, _per_doc(letters, words.doc_bytes),
                         _per_doc(_SYMBOL[words.data], words.doc_bytes), [d for d, _ in lines],
                         repeated_window_words(words)]
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column(0), part.column(1),
                     pa.array([xxhash.xxh3_128_digest(t.encode()) for t in texts], pa.binary()),
                     *(pa.array(s, pa.int64()) for s in stats),
                     pa.array([[{"line": k, "words": w} for k, w in found.items()] for _, found in lines],
                              _SCHEMA.field("lines").type)], schema=_SCHEMA)
                row += n

    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{host_col}`").cast("string").alias("host"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    return stage(plain.mapInArrow(run, "row long, id long, host string, text binary, " + "".join(f"{c} long, " for c in STATS)
                                  + "lines array<struct<line:binary,words:long>>"), "statistics")


def frequent_lines(stats: DataFrame, max_share: int = MAX_SHARE, min_docs: int = MIN_DOCS,
                   copies_once: bool = False) -> DataFrame:
    """(host, line): the lines above their host's limit."""
    docs = stats.select("host", "text")
    each = stats.select("host", "text", F.explode("lines.line").alias("line"))
    if copies_once:  # grouped, not gathered: a text's copies become one row before they move
        docs, each = docs.distinct(), each.distinct()
    hosts = docs.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("host_docs"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("docs"))
    return (counts.filter(F.col("docs") >= min_docs).join(hosts, F.col("host").eqNullSafe(F.col("h")))
            .filter(100 * F.col("docs") > max_share * F.col("host_docs")).select("host", "line"))


def line_frequency_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                         min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED, max_share: int = MAX_SHARE,
                         min_docs: int = MIN_DOCS, max_removed: int = MAX_REMOVED,
                         copies_once: bool = False) -> DataFrame:
    """(id, statistics, base_failed, n_removed_words, removed_lines, kept) per document;
    removed_lines are the 128-bit hashes of its lines above the limit."""
    stats = document_statistics(docs, id_col, text_col, host_col)
    limits = frequent_lines(stats, max_share, min_docs, copies_once).select(F.col("host").alias("h"), F.col("line").alias("l"))
    each = stats.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.words")
    hits = each.join(limits, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("l")), "left_semi")
    lost = hits.groupBy("row").agg(F.sum("words").alias("lost"), F.collect_set("line").alias("removed_lines"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    removed = F.coalesce("lost", F.lit(0))
    return (stats.drop("lines", "host", "text").join(lost, "row", "left")
            .select(F.col("id").alias(id_col), *STATS, failed.alias("base_failed"), removed.alias("n_removed_words"),
                    "removed_lines", (~failed & (100 * removed <= max_removed * F.col("n_words"))).alias("kept")))


def without_lines(texts: pa.Array, removed: pa.Array) -> pa.Array:
    """Each text without the lines whose hash is listed."""
    out = []
    for text, hashes in zip(texts.to_pylist(), removed.to_pylist()):
        if hashes and text:
            gone = set(hashes)
            text = "\n".join(x for x in text.split("\n") if (line_key(x) or (None,))[0] not in gone)
        out.append(text)
    return pa.array(out, pa.string())


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` without the rejected documents, and their texts without the lines above the limits;
    the columns stay as they are.  Rows with equal ids go if one of them is rejected.  Copies count once."""
    key, gone, names = free_name(docs, "verdict_id"), free_name(docs, "removed_lines"), list(docs.columns)
    verdict = (line_frequency_rules(docs, id_col, text_col, host_col, copies_once=True).groupBy(F.col(id_col).alias(key))
               .agg(F.min("kept").alias("kept"), F.array_distinct(F.flatten(F.collect_list("removed_lines"))).alias(gone))
               .filter("kept").select(key, gone))
    rows = docs.join(verdict, F.col(f"`{id_col}`").eqNullSafe(F.col(key)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index(text_col)
            columns = batch.columns[:-1]
            columns[at] = without_lines(columns[at], batch.columns[-1])
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*[F.col(f"`{c}`") for c in names], gone).mapInArrow(run, docs.schema)


def oracle_sql() -> str:
    """The same on table documents with the default limits, in DuckDB SQL (lines compared as texts)."""
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda s: s <> '') AS words FROM d),
tok AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w) x),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tok) t WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) s(k) GROUP BY doc_id),
ln AS (SELECT doc_id, source, line, list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda s: s <> '') AS lw
       FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d) x),
lines AS (SELECT doc_id, source, line, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM ln WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
freq AS (SELECT l.source, l.norm FROM (SELECT source, norm, count(DISTINCT doc_id) AS docs FROM lines GROUP BY source, norm) l
         JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source
         WHERE l.docs >= {MIN_DOCS} AND 100 * l.docs > {MAX_SHARE} * h.docs),
lost AS (SELECT l.doc_id, sum(l.n) AS n FROM lines l JOIN freq f ON f.source IS NOT DISTINCT FROM l.source AND f.norm = l.norm
         GROUP BY l.doc_id),
base AS (SELECT d.doc_id, len(w.words)::BIGINT AS n_words, coalesce(list_sum(list_transform(w.words, lambda s: length(s))), 0)::BIGINT AS word_chars,
           (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0) AS lost
         FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
         AND 100 * lost <= {MAX_REMOVED} * n_words AS kept
FROM base"""
