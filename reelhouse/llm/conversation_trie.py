"""Prefix trie of conversations by fixed-length block hashing (operator 13).

A node is a distinct sequence of first d turns (role, text); its members are the conversations
that start with it.

1. A conversation is cut into blocks of ``BLOCK`` turns.  A turn's 128-bit digest covers role,
   text and position, a block's digest is the exclusive or of its turns', a path's that of its
   blocks': digests of any prefix can be put together in any order, so a conversation of any
   length spreads over tasks.
2. Conversations are grouped by path digest, block by block.  If all members of a path that go
   on have the same next block, the block is *straight*: its turns have the same members, and
   one representative states them.
3. Only where siblings diverge is the block refined: each member's path digests after every
   single turn inside it are grouped.

A straight block, or one turn of a diverging one, is a *set* of nodes with equal members.  Its
owner is its smallest member.  Along a path members only leave, so a conversation owns the nodes
from some depth on to its end.  Sums over a subtree thus need no recursion over its depth:

* each leaf is held by one conversation, the smallest that ends there: leaves of a subtree =
  such conversations among the members;
* each node is held by its owner: what a subtree saves = all that its members own, less what the
  owner of its top owns above it.

The ids that end at a node are hashed as a stream: sorted rows are joined into runs of ids by
range-partitioned tasks, and a node's runs pass through one hash, never held together.

Defined cases: null role or text counts as empty; a null turn comes first, turns that tie are
ordered by role and text, repeated rows are turns of their own; a row without conversation id
belongs to no conversation; a conversation without turns is a member of the root; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm import chunks as C

BLOCK = 4           # turns per block
SPAN = 4096         # positions summed before sums run over a whole conversation
SALTS = 16          # parts of a path that many conversations share, when its members are looked up
RUN_IDS = 1 << 16   # ids joined into one text before a node's ids are hashed

KEY = ["ka", "kb", "depth"]


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv, pos, role, text) with pos from 1 in turn order, written once.

    Rows are range-partitioned on the whole order, so the turns of one conversation may span
    tasks; what precedes them in earlier tasks is added from a table of at most two
    rows per task."""
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).filter("conv IS NOT NULL")
    # the last key only spreads repeated rows
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    rows = rows.withColumn("copy", F.monotonically_increasing_id())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            new = np.ones(len(conv), dtype=bool)
            new[1:] = conv[1:] != conv[:-1]
            head = np.flatnonzero(new)
            local = np.arange(len(conv)) - np.repeat(head, np.diff([*head, len(conv)])) + 1
            if conv[0] == last:
                local[:head[1] if len(head) > 1 else None] += seen
            last, seen = conv[-1], int(local[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(local), *batch.columns[1:]],
                                             names=["conv", "local", "role", "text", "part"])

    sorted_rows = (rows.repartitionByRange(C.shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                   .select("conv", "role", "text", F.spark_partition_id().alias("part")))
    turns = C.stage(sorted_rows.mapInArrow(count, "conv long, local long, role string, text string, part int"), "turns")
    parts = turns.groupBy("conv", "part").agg(F.max("local").alias("n"))
    # a conversation that goes on in a later task stands at the end of one, or starts the next
    edges = turns.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    edges = edges.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("conv"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (parts.join(edges, ["part", "conv"], "left_semi").withColumn("carry", F.sum("n").over(before))
             .filter("carry IS NOT NULL").select("conv", "part", "carry"))
    return (turns.join(F.broadcast(carry), ["conv", "part"], "left")
            .select("conv", (F.col("local") + F.coalesce("carry", F.lit(0))).alias("pos"), "role", "text"))


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _before(df: DataFrame, key: str, at: str, values: list[str], fold) -> DataFrame:
    """``df`` with, for each of ``values``, its fold over the rows of the same key with smaller
    ``at`` as before_<value> (0 if none).  Folded per span of ``at`` first, so a key with very
    many rows is no single task's."""
    df = df.withColumn("span", F.floor(F.col(at) / SPAN))
    earlier = Window.partitionBy(key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(key, "span").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    spans = (df.groupBy(key, "span").agg(*[fold(v).alias(v) for v in values])
             .select(key, "span", *[F.coalesce(fold(v).over(earlier), F.lit(0)).alias(f"far_{v}") for v in values]))
    near = df.select("*", *[F.coalesce(fold(v).over(inside), F.lit(0)).alias(f"near_{v}") for v in values])
    out = near.join(spans, [key, "span"])
    both = {v: F.struct(F.col(f"far_{v}").alias("far"), F.col(f"near_{v}").alias("near")) for v in values}
    join = _xor if fold is F.bit_xor else lambda a, b: a + b
    return out.select(*[c for c in df.columns if c != "span"],
                      *[join(s["far"], s["near"]).alias(f"before_{v}") for v, s in both.items()])


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv, k, turns, a, b, before_a, before_b): each block, its digest and that of its path."""
    digest = [F.xxhash64(F.lit(seed), "role", "text", "pos") for seed in (1, 2)]
    t = turns.select("conv", "pos", digest[0].alias("a"), digest[1].alias("b"),
                     F.octet_length("text").cast("long").alias("bytes"))
    blocks = (t.groupBy("conv", F.floor((F.col("pos") - 1) / BLOCK).alias("k"))
              .agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "bytes"))).alias("turns"),
                   F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")))
    return _before(blocks, "conv", "k", ["a", "b"], F.bit_xor)


def _pieces(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """(conv, ka, kb, depth, up_a, up_b, up_depth, turns): what each conversation adds to the sets
    of nodes: itself at the root, a straight block as a whole, a diverging one turn by turn."""
    path = ["before_a", "before_b", "k"]
    blocks = blocks.withColumns({"after_a": _xor(F.col("before_a"), F.col("a")),
                                 "after_b": _xor(F.col("before_b"), F.col("b")), "r": F.size("turns")})
    split = (blocks.filter("k > 0").select(*path, "after_a", "after_b", "r").distinct()
             .groupBy(*path).agg(F.count("*").alias("kinds")).filter("kinds > 1")
             .select(*path, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("split")))
    # the root's members diverge in any case: no lookup under one key
    later = (blocks.filter("k > 0").withColumn("salt", F.pmod(F.xxhash64("conv"), F.lit(SALTS)).cast("int"))
             .join(split, [*path, "salt"], "left").drop("salt"))
    marked = blocks.filter("k = 0").withColumn("split", F.lit(True)).unionByName(later)

    def upto(i: Column, name: str) -> Column:
        """Path digest after the block's first i turns."""
        return F.aggregate(F.slice("turns", 1, i), F.col(f"before_{name}"), lambda x, t: _xor(x, t[name]))

    first = F.col("k") * BLOCK
    single = F.transform(F.sequence(F.lit(1), F.col("r")), lambda i: F.struct(
        upto(i, "a").alias("ka"), upto(i, "b").alias("kb"), (first + i).alias("depth"),
        upto(i - 1, "a").alias("up_a"), upto(i - 1, "b").alias("up_b"), (first + i - 1).alias("up_depth"),
        F.transform(F.slice("turns", i, 1), lambda t: t["bytes"]).alias("turns")))
    whole = F.array(F.struct(
        F.col("after_a").alias("ka"), F.col("after_b").alias("kb"), (first + F.col("r")).alias("depth"),
        F.col("before_a").alias("up_a"), F.col("before_b").alias("up_b"), first.alias("up_depth"),
        F.transform("turns", lambda t: t["bytes"]).alias("turns")))
    pieces = (marked.select("conv", F.explode(F.when(F.coalesce("split", F.lit(False)), single).otherwise(whole)).alias("p"))
              .select("conv", "p.*"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = members.select("conv", zero.alias("ka"), zero.alias("kb"), zero.alias("depth"), none.alias("up_a"),
                          none.alias("up_b"), none.alias("up_depth"), F.array(zero).alias("turns"))
    return C.stage(pieces.unionByName(root), "trie-pieces")


def _ends(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """(ka, kb, depth, n_ends, ends_sha256) of every node at which conversations end."""
    last = blocks.groupBy("conv").agg(F.max_by(F.struct(
        _xor(F.col("before_a"), F.col("a")).alias("ka"), _xor(F.col("before_b"), F.col("b")).alias("kb"),
        (F.col("k") * BLOCK + F.size("turns")).alias("depth")), "k").alias("end"))
    at = members.join(last, "conv", "left").select(
        *[F.coalesce(F.col("end")[c], F.lit(0)).alias(c) for c in KEY], "conv")
    order = [*KEY, "conv"]

    def groups(key: list[np.ndarray]) -> np.ndarray:
        new = np.ones(len(key[0]), dtype=bool)
        new[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in key])
        return np.flatnonzero(new)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy() for c in batch.columns]
            cuts = np.union1d(groups(cols[:3]), np.arange(0, batch.num_rows, RUN_IDS))
            ids = [",".join(map(str, part.tolist())) for part in np.split(cols[3], cuts[1:])]
            yield pa.RecordBatch.from_pydict(
                {c: x[cuts] for c, x in zip(order, cols)} | {"n": np.diff([*cuts, batch.num_rows]), "ids": ids},
                schema=pa.schema([(c, pa.int64()) for c in [*order, "n"]] + [("ids", pa.string())]))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in [*KEY, "n_ends"]] + [("ends_sha256", pa.string())])
        now, sha, n = None, None, 0
        for batch in batches:
            done = []
            for *key, more, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)]):
                if key != now:
                    if now is not None:
                        done.append((*now, n, sha.hexdigest()))
                    now, sha, n = key, hashlib.sha256(ids.encode()), more
                else:
                    sha.update(b"," + ids.encode())
                    n += more
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), schema)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in
                                              zip((*now, n, sha.hexdigest()), schema)], schema=schema)

    n = C.shuffle_partitions(members.sparkSession)
    joined = (at.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .mapInArrow(runs, "ka long, kb long, depth long, conv long, n long, ids string"))
    return C.stage(joined.repartition(n, *KEY).sortWithinPartitions(*order)
                   .mapInArrow(hashed, "ka long, kb long, depth long, n_ends long, ends_sha256 string"), "trie-ends")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv, pos, role, text), pos from 1 without gaps, over
    the conversations ``members`` (conv, distinct): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = C.stage(_blocks(turns), "trie-blocks")
    pieces, ends = _pieces(blocks, members), _ends(blocks, members)
    # equal sets have equal turns and parents
    sets = C.stage(pieces.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("owner"), F.first("turns").alias("turns"),
        *[F.first(c).alias(c) for c in ("up_a", "up_b", "up_depth")]), "trie-sets")

    first = F.col("depth") - F.size("turns") + 1
    nodes = (sets.select(*KEY, "owner", "n_convs", "up_a", "up_b", "up_depth", F.posexplode("turns").alias("i", "bytes"), first.alias("first"))
             .select(F.col("ka").alias("set_a"), F.col("kb").alias("set_b"), F.col("depth").alias("set_depth"),
                     "owner", "n_convs", "up_a", "up_b", "up_depth", "i", (F.col("first") + F.col("i")).alias("depth"),
                     ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))
    owned = sets.groupBy(F.col("owner").alias("conv")).agg(
        F.sum((F.col("n_convs") - 1) * F.aggregate("turns", F.lit(0).cast("long"), lambda x, t: x + t)).alias("owned"))
    leaves = (sets.join(ends, KEY).filter("n_convs = n_ends").select(F.col("owner").alias("conv"), F.lit(1).alias("leaf")))
    held = owned.join(leaves, "conv", "left").filter("owned > 0 OR leaf = 1")
    sums = pieces.join(held, "conv").groupBy(*KEY).agg(
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"), F.sum("owned").alias("below"))

    up = {"up_a": "ka", "up_b": "kb", "up_depth": "depth"}
    children = (sets.filter("up_depth IS NOT NULL").groupBy(*up).agg(F.count("*").alias("n_sets"))
                .withColumnsRenamed(up))
    known = sets.select(*KEY, "owner").join(children, KEY, "left").join(sums, KEY).join(ends, KEY, "left")
    known = C.stage(known, "trie-known").withColumnsRenamed({"ka": "set_a", "kb": "set_b", "depth": "set_depth"})
    parents = (known.filter("n_sets IS NOT NULL")
               .select(F.col("set_a").alias("up_a"), F.col("set_b").alias("up_b"), F.col("set_depth").alias("up_depth"),
                       F.col("owner").alias("up_owner"),
                       F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))

    nodes = _before(nodes, "owner", "depth", ["saved"], F.sum)
    nodes = nodes.join(known.drop("owner"), ["set_a", "set_b", "set_depth"])
    nodes = (nodes.withColumn("salt", F.pmod(F.xxhash64("owner"), F.lit(SALTS)).cast("int"))
             .join(parents, ["up_a", "up_b", "up_depth", "salt"], "left"))
    at_end = F.col("depth") == F.col("set_depth")
    return nodes.select(
        F.col("owner").alias("conv_id"), "depth",
        F.when(F.col("i") == 0, F.col("up_owner")).otherwise(F.col("owner")).alias("parent_conv_id"), "n_convs",
        F.when(at_end, F.coalesce("n_sets", F.lit(0))).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), (F.col("below") - F.col("before_saved")).alias("saved_tokens"),
        F.coalesce(F.when(at_end, F.col("ends_sha256")), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def regrafted(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of every conversation c rebuilt: the first h turns of conversation c - c % 5, then
    c's own after its first h; h is the CRC-32 of c's decimal modulo 9."""
    own = numbered_turns(conversations)
    members = (conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv")).distinct()
               .withColumns({"h": F.crc32(F.col("conv").cast("string").cast("binary")) % 9,
                             "base": F.col("conv") - F.col("conv") % 5}))
    head = own.filter("pos <= 8").withColumnRenamed("conv", "base")
    grafted = members.join(head, "base").filter("pos <= h").select("conv", "pos", "role", "text")
    taken = grafted.groupBy("conv").agg(F.max("pos").alias("taken"))
    rest = (own.join(members.select("conv", "h"), "conv").filter("pos > h").join(taken, "conv", "left")
            .select("conv", (F.col("pos") - F.col("h") + F.coalesce("taken", F.lit(0))).alias("pos"), "role", "text"))
    return grafted.unionByName(rest), members.select("conv")


def oracle_sql() -> str:
    """DuckDB SQL of the trie of the rebuilt conversations, each node by the md5 of its turns."""
    h = ("(SELECT list_reduce(list_prepend(4294967295::BIGINT, string_split(conv_id::VARCHAR, '').list_transform(lambda x: ascii(x)::BIGINT)), "
         "lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)), lambda v, i: "
         "CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)))")
    return f"""
WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
             FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor(4294967295::BIGINT, {h}) % 9 AS h FROM (SELECT DISTINCT conv_id FROM own) x),
t AS (SELECT c.conv_id, 0 AS part, own.pos, own.role, own.text FROM c JOIN own ON own.conv_id = c.conv_id - c.conv_id % 5 AND own.pos <= c.h
      UNION ALL SELECT c.conv_id, 1, own.pos, own.role, own.text FROM c JOIN own ON own.conv_id = c.conv_id AND own.pos > c.h),
s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, strlen(text) AS bytes,
             md5(strlen(role)::VARCHAR || ':' || role || text) AS turn FROM t),
p AS (SELECT conv_id, depth, bytes, md5(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
             depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM s
      UNION ALL SELECT conv_id, 0, 0, 'root', conv_id NOT IN (SELECT conv_id FROM s) FROM c),
node AS (SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
                string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end) AS ends FROM p GROUP BY node),
edge AS (SELECT node.node, node.depth, up.node AS parent, node.saved FROM node JOIN p up ON up.conv_id = node.conv_id AND up.depth = node.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n FROM edge GROUP BY parent),
below AS (SELECT up.node, sum(low.saved) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
          FROM node low JOIN p up ON up.conv_id = low.conv_id AND up.depth <= low.depth LEFT JOIN kids ON kids.node = low.node GROUP BY up.node)
SELECT node.conv_id, node.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN below ON below.node = node.node LEFT JOIN kids ON kids.node = node.node
LEFT JOIN edge ON edge.node = node.node LEFT JOIN node up ON up.node = edge.parent"""
