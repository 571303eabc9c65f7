"""N-gram Jaccard join (operator 5): which documents share at least 75 % of their
five-word shingles, and the groups that these links form.

Rare-first prefix filtering, exact:

1. every shingle's document count over the whole corpus (``chunks.answers``); the
   global order is (count, hash), rare first;
2. two sets of sizes n and m that reach the threshold share a shingle among the first
   n - ceil(t n) + 1 of one and m - ceil(t m) + 1 of the other.  A shingle that stands in
   one document only joins nothing, so a document with fewer than ceil(t n) shared
   shingles has no partner and leaves here with one row;
3. equal sets are one class, represented by one document;
4. representatives are posted under the shared shingles of their prefix and joined on
   them with the length filter, the positional filter (what two prefixes and the rest
   can still share) and the suffix filter: shingles that stand in one document only are
   not common, and the others are cut into 1024 hash ranges, of which one whose parity differs
   holds at least one shingle that only one of the two has;
5. each pair that is left is verified once, on the exact sets.

A large group of near copies would make the square of its size in pairs.  So a first
round links members to one pivot of their list and length band only, the one with the
fewest shingles of its own (most like what the others were copied from); the second round
takes all pairs of a list whose members the first has not yet put in the same group.
Any pair left out is between documents already known to be connected, so no component
is lost.  A list is cut into blocks; only members outside its largest group are copied
to all blocks.

Defined cases: null or wordless text has no shingles and no link; under five words, the
whole word sequence is the one shingle; rows with equal ids are separate documents that
report their own row; a null id takes part and never becomes a component id unless its
component has no other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import chunks as C
from reelhouse.llm.components import ID_ROWS, connected_components
from reelhouse.llm.words import Words, mix, window_hashes, words_of

RANGES = 1024        # hash ranges of the suffix filter
SALTS = 16           # parts in which the copies of one set are looked up
LIST_BLOCK = 4096    # members of a posting list that meet in one block


def shingles(words: Words, size: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each document's distinct shingles, sorted."""
    h, n = words.hashes(lower=lower), words.n_words
    doc = np.repeat(np.arange(len(n)), n)
    full = np.flatnonzero(words.room() >= size)
    docs, keys = [doc[full]], [window_hashes(h, size)[full]]
    for short in range(1, size):
        which = np.flatnonzero(n == short)
        docs.append(which)
        keys.append(mix(window_hashes(h, short)[words.doc_words[which]] + np.uint64(short)))
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[new], key[new]


def _count(chunks: DataFrame, size: int, bits: int, bounds: np.ndarray) -> DataFrame:
    def emit(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, keys = shingles(words_of(C.unpack_table(row["docs"])["_text"]), size)
                found = list(C.count_blobs(keys >> np.uint64(64 - bits), bounds))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [row["chunk"]] * len(found), "bucket": [f[0] for f in found],
                     "keys": [f[1] for f in found], "counts": [f[2] for f in found]},
                    schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()),
                                      ("keys", pa.binary()), ("counts", pa.binary())]))

    return C.answers(chunks.select("chunk", "docs").mapInArrow(
        emit, "chunk long, bucket int, keys binary, counts binary"))


SET_SCHEMA = ("row long, id long, n long, sig_a long, sig_b long, items binary, "
              "core double, lone long, prefix array<long>, places array<int>, parity array<long>")


def _sets(chunks: DataFrame, replies: DataFrame, size: int, bits: int, percent: int) -> DataFrame:
    """One row per document; the set columns are filled only where a partner is possible."""
    def run(row, reply):
        table = C.unpack_table(row["docs"])
        doc, key = shingles(words_of(table["_text"]), size)
        count = C.totals(reply, key >> np.uint64(64 - bits))
        n = np.bincount(doc, minlength=len(table))
        shared = np.bincount(doc[count > 1], minlength=len(table))
        need = -(-percent * n // 100)
        going = (n > 0) & (shared >= need)
        first = np.concatenate([[0], np.cumsum(n)])
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(key + np.uint64(k)), dtype=np.uint64)])
                for k in (1, 2)]
        sig = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
        out = {c: [None] * len(table) for c in ("items", "core", "lone", "prefix", "places", "parity", "sig_a", "sig_b")}
        for d in np.flatnonzero(going):
            k, c = key[first[d]:first[d + 1]], count[first[d]:first[d + 1]]
            order = np.lexsort((k, c))[:n[d] - need[d] + 1]
            place = np.flatnonzero(c[order] > 1)
            odd = np.bincount((k[c > 1] & np.uint64(RANGES - 1)).astype(np.int64), minlength=RANGES) & 1
            out["items"][d] = C.pack_sorted(k[c > 1])
            out["prefix"][d] = k[order[place]].view(np.int64)
            out["places"][d] = place.astype(np.int32)
            out["core"][d], out["lone"][d] = shared[d] / n[d], n[d] - shared[d]
            out["parity"][d] = np.packbits(odd.astype(np.uint8)).view(np.int64)
            out["sig_a"][d], out["sig_b"][d] = int(sig[0][d]), int(sig[1][d])
        yield pd.DataFrame({"row": table[C.ROW].to_numpy(), "id": table["_id"].to_pylist(), "n": n} | out)

    return C.with_replies(chunks, replies, ["docs"], run, SET_SCHEMA)


def _verified(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose sets reach the threshold, decided on the whole sets."""
    side = [reps.select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("items").alias(f"items_{x}"))
            for x in "ab"]

    def run(frames):
        for pdf in frames:
            common = [len(np.intersect1d(C.unpack_sorted(x), C.unpack_sorted(y), assume_unique=True))
                      for x, y in zip(pdf["items_a"], pdf["items_b"])]
            common = np.array(common, dtype=np.int64)
            ok = 100 * common >= percent * (pdf["n_a"] + pdf["n_b"] - common).to_numpy()
            yield pdf.loc[ok, ["a", "b"]]

    return pairs.join(side[0], "a").join(side[1], "b").mapInPandas(run, "a long, b long")


def _may_link(x: str, y: str, percent: int):
    """Length, positional and suffix filter between postings ``x`` and ``y`` of one list."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    i, j = F.col(f"{x}.place"), F.col(f"{y}.place")
    # overlap o reaches the threshold when (100 + t) * o >= t * (n + m)
    # lone shingles come first in the order, so a posted one has all of its set's before it
    lone_x, lone_y = F.col(f"{x}.lone"), F.col(f"{y}.lone")
    reach = F.least(i - lone_x, j - lone_y) + F.least(n - i, m - j)
    apart = lone_x + lone_y + sum((F.bit_count(F.col(f"{x}.p{i}").bitwiseXOR(F.col(f"{y}.p{i}"))) for i in range(RANGES // 64)), F.lit(0))
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & ((100 + percent) * reach >= percent * (n + m))
            & ((100 + percent) * apart <= (100 - percent) * (n + m)))


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                  percent: int = 75, chunk_bytes: int = C.CHUNK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, classes, links): one row (row, id, n, sig_a, sig_b) per document, one row
    (sig_a, sig_b, rep) per class of equal sets that may have partners, and verified links
    (a, b) between representatives that connect every component."""
    chunks = C.stage_chunks(docs, id_col, text_col, None, chunk_bytes)
    bits = C.key_bits(chunks)
    bounds = C.bucket_bounds(C.BUCKETS_PER_TASK * C.shuffle_partitions(docs.sparkSession), bits)
    sets = C.stage(_sets(chunks, _count(chunks, shingle, bits, bounds), shingle, bits, percent), "sets")
    C.discard(chunks)
    able = sets.filter("items IS NOT NULL")
    classes = able.groupBy("sig_a", "sig_b").agg(F.min("row").alias("rep"))
    reps = C.stage(able.join(classes.select(F.col("rep").alias("row")), "row", "left_semi")
                   .select("row", "n", "items", "core", "lone", "prefix", "places", "parity"), "representatives")
    parity = [F.col("parity")[i].alias(f"p{i}") for i in range(RANGES // 64)]
    lists = (reps.select("row", "n", "core", "lone", *parity, F.explode(F.arrays_zip("prefix", "places")).alias("p"))
             .select(F.col("p.prefix").alias("key"), "row", "n", F.col("p.places").alias("place"), "core", "lone",
                     *[f"p{i}" for i in range(RANGES // 64)]))

    # first round: members against the pivot of their list and length band
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    banded = lists.select("key", "row", "n", "core", band.alias("band"))
    pivots = (banded.groupBy("key", "band")
              .agg(F.max_by(F.struct("row", "n"), F.struct("core", "row")).alias("pivot"), F.count("*").alias("size"))
              .filter("size > 1").select("key", "band", "pivot.row", "pivot.n")
              .withColumnsRenamed({"row": "pivot", "n": "pivot_n"}))
    first = C.stage(banded.join(pivots, ["key", "band"])
                    .filter((F.col("row") != F.col("pivot"))
                            & (100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")))
                    .select(F.col("pivot").alias("a"), F.col("row").alias("b")).distinct(), "pairs-1", ID_ROWS)
    links = C.stage(_verified(first, reps, percent), "links-1")

    # second round: the pairs of a list between different groups
    label = connected_components(links, "a", "b").withColumnsRenamed({"node": "row", "root": "label"})
    posted = posted_table = C.stage(lists.drop("core").join(label, "row", "left").withColumn("label", F.coalesce("label", "row")), "postings")
    sizes = (posted.groupBy("key", "label").agg(F.count("*").alias("size"))
             .groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("main"),
                                 F.sum("size").alias("size"), F.count("*").alias("groups"))
             .filter("groups > 1")
             .select("key", "main", F.ceil(F.col("size") / LIST_BLOCK).cast("int").alias("blocks")))
    posted = posted.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    minor = posted.filter("label != main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = posted.filter("label = main").withColumn("block", F.col("own")).unionByName(minor)
    x, y = minor.alias("x"), every.alias("y")
    pairs = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.block") == F.col("y.block"))
                    & (F.col("x.label") != F.col("y.label"))
                    & ((F.col("y.label") == F.col("y.main"))
                       | ((F.col("x.row") < F.col("y.row")) & (F.col("x.own") == F.col("x.block"))))
                    & _may_link("x", "y", percent))
             .select(F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b")).distinct())
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = _verified(pairs.join(tested, ["a", "b"], "left_anti"), reps, percent)
    found = C.stage(links.unionByName(second), "links")
    C.discard(reps, first, links, posted_table)
    return sets.select("row", "id", "n", "sig_a", "sig_b"), classes, found


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                       percent: int = 75, chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """(id, n_shingles, component_id) per document: the size of its set and the smallest id
    reachable over links, its own included."""
    sets, classes, links = jaccard_links(docs, id_col, text_col, shingle, percent, chunk_bytes)
    roots = connected_components(links, "a", "b")
    grouped = (classes.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
               .select("sig_a", "sig_b", F.coalesce("root", "rep").alias("root"),
                       F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    able = sets.filter("sig_a IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    member = C.stage(able.join(grouped, ["sig_a", "sig_b", "salt"])
                     .select("row", "id", "n", "root"), "members")
    smallest = member.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = member.join(smallest, "root").select("id", "n", "component_id")
    alone = sets.filter("sig_a IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                            "component_id")
