"""Operators 11, 12 and 13 against brute force on awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelhouse.llm import conversation_trie, lexical_search, suffix_dedup
from reelhouse.llm.conversation_trie import numbered_turns, prefix_trie, regrafted
from reelhouse.llm.intervals import repeated_starts
from reelhouse.llm.lexical_search import ranked_search, terms_of
from reelhouse.llm.suffix_dedup import remove_repeated_bytes

from .edge_cases import ROWS, documents, empty, prose

# --- 11: ranked search ---------------------------------------------------------------

ITEMS = [(1, "Three short words, three!"), (2, None), (3, ""), (4, "... \n"), (5, "naïve テキスト word WORD x1"),
         (6, prose(80, 2)), (6, "license under the MIT License"), (None, "l1 a b c d"), (8, "absentterm"),
         (9, " ".join(prose(40, s) for s in range(20, 40)))]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "item_id long, text string, rank string, doc string")


def brute_search(docs, queries, k):
    terms = [Counter(terms_of(t)) for _, t in docs]
    n = [sum(c.values()) for c in terms]
    total, many = sum(n), sum(x > 0 for x in n)
    df = Counter(t for c in terms for t in c)
    out = []
    for item, text in queries:
        found = []
        for (doc, _), held, size in zip(docs, terms, n):
            score = 0
            for term, times in Counter(terms_of(text)).items():
                if held[term]:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[term] + 1)))
                    m = 75 + 25 * size * many // total
                    score += times * w * (1_000_000_000 * held[term] // (1000 * held[term] + 12 * m))
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return out


def total_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


@pytest.mark.parametrize("k, block, cells, piece", [(20, 20_000, 1 << 21, 1 << 20), (3, 2, 8, 64)])
def test_ranking(spark, monkeypatch, k, block, cells, piece):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", block)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    monkeypatch.setattr(lexical_search, "SLICE_BYTES", piece)
    got = [tuple(r) for r in ranked_search(documents(spark), items(spark), k).collect()]
    assert total_order(got) == total_order(brute_search(ROWS, ITEMS, k))


def test_terms_stand_whole(spark):
    docs = documents(spark, [(1, "cat"), (2, "concat cat-cat CAT"), (3, "cats"), (4, "catalog\tcat\x7fé"), (5, "Écat")])
    got = ranked_search(docs, items(spark, [(1, "cat")]))
    assert {r.doc_id for r in got.collect()} == {1, 2, 4}
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_rank_by_id(spark):
    docs = documents(spark, [(i, "same text") for i in (9, 3, None, 7, 3, 1)] + [(20, "other"), (21, "one more"), (22, "words")])
    got = ranked_search(docs, items(spark, [(1, "text")]), 4).orderBy("rank").collect()
    assert [(r["rank"], r.doc_id) for r in got] == [(1, None), (2, 1), (3, 3), (4, 3)]


def test_search_of_nothing(spark):
    assert ranked_search(empty(spark), items(spark)).isEmpty()
    assert ranked_search(documents(spark), items(spark, [])).isEmpty()
    assert ranked_search(documents(spark, [(1, None), (2, ""), (3, "?!")]), items(spark)).isEmpty()


def test_length_norm_beyond_64_bits():
    n = np.array([10**8, 5], dtype=np.int64)
    assert lexical_search.length_norm(n, 10**13, 10**16).tolist() == [75 + 25 * x * 10**13 // 10**16 for x in (10**8, 5)]


# --- 12: repeated bytes ----------------------------------------------------------------

def brute_bytes(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k:k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def check_bytes(spark, rows, length, partitions=3, **kw):
    got = remove_repeated_bytes(documents(spark, rows, partitions), length=length, **kw).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(brute_bytes(rows, length), key=key)


@pytest.mark.parametrize("length, chunk, piece, batch", [(400, 20_000, 1 << 18, 1 << 20), (50, 2_000, 700, 900),
                                                         (33, 10**6, 1 << 18, 100), (8, 5_000, 1000, 1 << 20)])
def test_repeated_bytes(spark, monkeypatch, length, chunk, piece, batch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    check_bytes(spark, ROWS, length, chunk_bytes=chunk)


def test_borders_and_one_long_text(spark):
    r = random.Random(5)
    alphabet = "abcdefgé "

    def noise(n):
        return "".join(r.choice(alphabet) for _ in range(n))

    passage, other = noise(450), noise(430)
    rows = [(k, noise(r.randint(0, 60)) + passage[r.randint(0, 40):] + noise(r.randint(0, 60))) for k in range(12)]
    rows += [(50, noise(30_000) + passage + other + noise(20_000) + other), (51, "ab" * 700), (52, "x" * 399), (53, "y" * 401)]
    rows += [(60, passage[:399]), (61, other[:400] + "!"), (61, other[:400] + "!"), (None, noise(800))]
    check_bytes(spark, rows, 400, chunk_bytes=5_000)


def test_bytes_keep_columns_and_empty_tables(spark):
    got = {r.doc_id: r for r in remove_repeated_bytes(documents(spark, [(1, "abcdefgh12"), (2, "xabcdefghy")]), length=8,
                                                      carry=["lang", "chunk"]).collect()}
    assert got[1].kept == b"12" and got[2].kept == b"xy" and got[2].lang == "en" and got[1].chunk == "clash"
    assert remove_repeated_bytes(empty(spark)).isEmpty()
    assert [r.n_removed for r in remove_repeated_bytes(documents(spark, [(1, None), (2, ""), (3, "z" * 400)])).collect()] == [0] * 3
    with pytest.raises(ValueError):
        remove_repeated_bytes(documents(spark), carry=["kept"])


def test_interval_expansion():
    r = random.Random(1)
    for _ in range(150):
        length = r.choice([3, 5, 8, 12, 20])
        alphabet = r.choice([b"ab", b"a", b"abc\x00\xff", bytes(range(256))])
        base = bytes(r.choice(alphabet) for _ in range(60))
        strings = [base[r.randint(0, 30):][:r.randint(length, 40)] + bytes(r.choice(alphabet) for _ in range(r.randint(0, 10)))
                   for _ in range(r.randint(1, 80))]
        strings = [s for s in strings if len(s) >= length] or [b"a" * length]
        seen = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
        for s, mask in zip(strings, repeated_starts(strings, length), strict=True):
            assert mask.tolist() == [seen[s[i:i + length]] > 1 for i in range(len(s) - length + 1)]


# --- 13: prefix trie -----------------------------------------------------------------------

def brute_trie(rebuilt):
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = own + sum(saved[c] for c in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(node))
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, pos string, depth int").repartition(partitions)


def in_order(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(ts)] for c, ts in turns.items()}


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=str)


def awkward_turns():
    r = random.Random(3)
    rows = [(None, 1, "user", "no conversation"), (100, None, None, None), (101, 0, "", ""), (102, 0, "user", "é" * 9)]
    rows += [(7, None, "user", "first"), (7, 3, "user", "b"), (7, 3, "user", "b"), (7, 3, "assistant", "b"), (7, -1, "x", None)]
    for c in range(20, 60):
        rows += [(c, t, "user" if t % 2 else "assistant", r.choice(["a", "b"])) for t in range(r.randint(1, 7))]
    for c in range(200, 230):   # one long shared beginning, and copies
        rows += [(c, t, "user", f"shared {t}") for t in range(14)] + [(c, 14 + t, "user", f"own {c % 4} {t}") for t in range(c % 3)]
    rows += [(300, t, "user", "again") for t in range(120)]
    return rows


@pytest.mark.parametrize("block, span, run", [(4, 4096, 1 << 16), (3, 2, 2), (1, 5, 1)])
def test_trie(spark, monkeypatch, block, span, run):
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    monkeypatch.setattr(conversation_trie, "SPAN", span)
    monkeypatch.setattr(conversation_trie, "RUN_IDS", run)
    rows = awkward_turns()
    df = conversations(spark, rows)
    members = df.filter("conv_id IS NOT NULL").selectExpr("conv_id AS conv").distinct()
    assert trie_rows(prefix_trie(numbered_turns(df), members)) == brute_trie(in_order(rows))


def test_regrafted_trie(spark):
    rows = awkward_turns()
    turns, members = regrafted(conversations(spark, rows))
    own = in_order(rows)
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + mine[h:]
    assert any(not t for t in rebuilt.values())
    assert trie_rows(prefix_trie(turns, members)) == brute_trie(rebuilt)


def test_one_conversation_over_many_tasks(spark):
    rows = [(5, t, "user", str(t)) for t in range(3000)] + [(6, 0, "user", "0"), (6, 1, "user", "z")] + [(8, 0, "user", "same")] * 500
    got = numbered_turns(conversations(spark, rows, 8))
    assert got.select("conv", "pos").distinct().count() == 3502
    assert got.filter("conv = 5 AND CAST(pos - 1 AS STRING) != text").isEmpty()
    assert got.filter("conv = 8").agg({"pos": "max"}).first()[0] == 500


def test_trie_of_nothing(spark):
    turns, members = regrafted(conversations(spark, []))
    assert prefix_trie(turns, members).isEmpty()
