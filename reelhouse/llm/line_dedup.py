"""Line dedup by overlapping three-line windows (operator 4), in DataFrame functions only.

A document's lines with a word are numbered; three consecutive ones, trimmed, make a
window.  Windows are hashed (128 bits) and grouped over the corpus with partial sums.  Every
occurrence of a repeated window but the first (smallest id, then smallest hash of the
text, then leftmost) is marked, the covered lines of a document are merged, and its text is
put together again without them.  Blank lines stay.

Only windows, not texts, meet in the grouping, and only repeated windows in the join after it,
whose hot keys Spark can split because no task needs a whole group.

Defined cases: null text has no lines and stays null; texts of fewer lines than the window
never change; rows with the same id and the same text are one document given several
times, and all of them get its result; rows with the same id and other texts are documents of
their own; a null id sorts first; an empty table gives an empty result; input columns named in
``carry`` come along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"


def _trimmed(line):
    return F.btrim(line, F.lit(BLANKS))


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3,
                          carry: list[str] | None = None) -> DataFrame:
    """(id, n_lines, n_removed, text, carried columns) per document; see the module."""
    extra = list(carry or [])
    clash = set(extra) & {id_col, text_col, "n_lines", "n_removed"}
    if clash:
        raise ValueError(f"carried columns clash with the result's: {sorted(clash)}")
    base = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
                       *[F.col(f"`{c}`").alias(f"_x{i}") for i, c in enumerate(extra)],
                       F.xxhash64(F.col(f"`{text_col}`")).alias("_hash"))
    numbered = F.filter(F.transform(F.split("_text", "\n"), lambda x, i: F.struct(i.alias("at"), _trimmed(x).alias("line"))),
                        lambda x: x["line"] != "")
    lines = base.select("_id", "_hash", numbered.alias("lines")).filter(F.size("lines") >= window)

    def member(i, k):
        return F.element_at("lines", (i + k).cast("int"))

    def key(i, seed):
        return F.xxhash64(F.lit(seed), *[member(i, k)["line"] for k in range(window)])

    windows = (lines.select("_id", "_hash", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("lines") - window + 1),
        lambda i: F.struct(F.array(*[member(i, k)["at"] for k in range(window)]).alias("at"),
                           key(i, 1).alias("a"), key(i, 2).alias("b")))).alias("w"))
        .select("_id", "_hash", "w.at", "w.a", "w.b"))
    place = F.struct("_id", "_hash", F.element_at("at", 1))  # nulls sort first
    repeated = (windows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first"))
                .filter("n > 1").select("a", "b", "first"))
    later = windows.join(repeated, ["a", "b"]).filter(~place.eqNullSafe(F.col("first")))
    cuts = (later.groupBy("_id", "_hash").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("gone"))
            .select(F.col("_id").alias("c_id"), F.col("_hash").alias("c_hash"), "gone"))
    joined = base.join(cuts, F.col("_id").eqNullSafe(F.col("c_id")) & F.col("_hash").eqNullSafe(F.col("c_hash")), "left")

    parts = F.split("_text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    n_lines = F.size(F.filter(parts, lambda x: _trimmed(x) != ""))
    return joined.select(
        F.col("_id").alias(id_col), F.when(F.col("_text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("_text"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")).alias(text_col),
        *[F.col(f"_x{i}").alias(c) for i, c in enumerate(extra)])


def oracle_sql(window: int = 3) -> str:
    """The same on table documents, in DuckDB SQL (windows compared as texts)."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    body = " || chr(10) || ".join(f"l{k}" for k in range(window))
    leads = ", ".join(f"lead(line, {k}) OVER w AS l{k}, lead(p, {k}) OVER w AS p{k}" for k in range(window))
    covered = ", ".join(f"p{k}" for k in range(window))
    return f"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
pos AS (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS p FROM raw),
ln AS (SELECT doc_id, p, parts[p] AS raw_line, trim(parts[p], {blanks}) AS line FROM pos),
num AS (SELECT * FROM ln WHERE line <> ''),
run AS (SELECT doc_id, p, {leads} FROM num WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
win AS (SELECT *, {body} AS body FROM run WHERE l{window - 1} IS NOT NULL),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, p) AS k FROM win) t
          WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest([{covered}]) AS p FROM later),
kept AS (SELECT ln.doc_id, string_agg(ln.raw_line, chr(10) ORDER BY ln.p) AS body
         FROM ln LEFT JOIN gone ON gone.doc_id = ln.doc_id AND gone.p = ln.p WHERE gone.p IS NULL GROUP BY ln.doc_id),
n_all AS (SELECT doc_id, count(*) AS n FROM num GROUP BY doc_id),
n_gone AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT r.doc_id, coalesce(n_all.n, 0)::BIGINT AS n_lines, coalesce(n_gone.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM raw r LEFT JOIN kept k ON k.doc_id = r.doc_id LEFT JOIN n_all ON n_all.doc_id = r.doc_id
LEFT JOIN n_gone ON n_gone.doc_id = r.doc_id"""
