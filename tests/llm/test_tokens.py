"""Operators 1, 2 and 3: exact ids, exact round trips, defined edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from reelhouse.llm import rans, shared_files
from reelhouse.llm.hilbert_pack import Sequences, hilbert_keys, pack_along_curve
from reelhouse.llm.queries import decimal_sha256, tokenizer_path
from reelhouse.llm.tokens import load
from reelhouse.llm.tree_bpe import decode_documents, encode_documents, join_all, leaves, vocabulary

from .edge_cases import ROWS, documents, empty

tokenizers = pytest.importorskip("tokenizers")
BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def library(path):
    return tokenizers.Tokenizer.from_file(path)


def random_text(rng):
    kind = rng.random()
    if kind < .25:
        return "".join(rng.choice("ab") for _ in range(rng.randint(1, 300)))
    if kind < .35:
        return rng.choice("aZ =-\n5é") * rng.randint(1, 200)
    if kind < .7:
        parts = ["'", "l", "re", "s", " ", "  ", "\n", "5", "12", "é", "ß", ".", "!!", "the", "日本", "'LL", "²", " "]
        return "".join(rng.choice(parts) for _ in range(rng.randint(1, 200)))
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABC+/01") for _ in range(rng.randint(1, 500)))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_cached_pieces_equal_the_library(path):
    rng = random.Random(1)
    texts = [random_text(rng) for _ in range(800)] + [t or "" for _, t in ROWS] + ["<|ENDOFTEXT|>x", "İ ŉ ſ", "a\x1cb"]
    for text, ids in zip(texts, load(path).encode_batch(texts)):
        assert ids.tolist() == library_ids(path, text)


_LIB = {}


def library_ids(path, text):
    if path not in _LIB:
        _LIB[path] = library(path)
    return _LIB[path].encode(text, add_special_tokens=False).ids


def test_joined_halves_equal_the_whole():
    rng, encoder, vocab = random.Random(2), load(BYTE), vocabulary(BYTE)
    for _ in range(400):
        text = random_text(rng) + (random_text(rng) if rng.random() < .5 else "")
        parts = leaves(text, rng.choice([7, 20, 64, 150]))
        assert "".join(parts) == text
        ids = join_all([encoder.encode_batch([p])[0] for p in parts], lambda t: encoder.encode_batch([t])[0], vocab)
        assert ids.tolist() == library_ids(BYTE, text)


def test_tree_bpe_on_awkward_rows(spark):
    out = encode_documents(documents(spark), BYTE, leaf_chars=200, decode=True)
    rows = out.select("doc_id", "token_ids", "text", decimal_sha256("token_ids").alias("sha")).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.text, r.token_ids, r.sha) for r in rows)
    want = []
    for i, t in ROWS:
        ids = library_ids(BYTE, t or "")
        want.append((i is not None, i or 0, t or "", ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    assert got == sorted(want)
    assert encode_documents(empty(spark), BYTE).isEmpty()
    apart = decode_documents(encode_documents(documents(spark), BYTE, leaf_chars=200), BYTE).collect()
    assert sorted(r.text for r in apart) == sorted(t or "" for _, t in ROWS)


def test_decode_replaces_broken_utf8(spark):
    ids = library_ids(BYTE, "é")[:1] + [50256]
    half = [i for i, b in enumerate(vocabulary(BYTE).tokens) if b == b"\xc3"]
    df = spark.createDataFrame([(ids,), (half,), (None,)], "token_ids array<int>")
    texts = [r.text for r in decode_documents(df, BYTE).collect()]
    assert texts == [library(BYTE).decode(ids, skip_special_tokens=False),
                     library(BYTE).decode(half, skip_special_tokens=False), ""]


def test_rans_files(spark):
    folder = shared_files.new_folder(spark, "rans-test")
    files = rans.write_ids(documents(spark), BYTE, 2, folder)
    got = sorted((r.start, r.n_tokens, r.ids_crc32, np.frombuffer(r.token_ids, "<u4").tolist(), r.id)
                 for r in rans.read_ids(files).collect())
    order = sorted(range(len(ROWS)), key=lambda k: (ROWS[k][0] is not None, ROWS[k][0] or 0))
    at, starts = 0, []
    for k, row in zip(order, got):
        ids = library_ids(BYTE, ROWS[k][1] or "") + [2]
        assert row == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids, ROWS[k][0])
        at += len(ids)
        starts.append(row[0])
    assert starts == sorted(starts)
    none = rans.write_ids(empty(spark), BYTE, 2, shared_files.new_folder(spark, "rans-test"))
    assert rans.read_ids(none).isEmpty()


def test_rans_segments_decode_alone_and_damage_is_found():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.geometric(0.002, 3 * rans.LANES * rans.SEGMENT_ROWS + 777), 50_000)
    table = rans.Table.from_bytes(rans.Table.of(ids).to_bytes())
    words, states, places = rans.encode_ids(ids, table)
    step = rans.LANES * rans.SEGMENT_ROWS
    assert len(states) == 4
    for i in (3, 1, 0, 2):
        part = ids[i * step:(i + 1) * step]
        out = rans.decode_segment(words.astype(np.uint64), states[i], int(places[i]), len(part), table.decoder(), table.symbols)
        assert (out == part).all()
    block = rans.pack_block(ids, np.array([5]), np.array([len(ids)]), table)
    assert len(block) < 2 * len(ids)
    assert (rans.unpack_block(block, table)[2] == ids).all()
    for at in (3, 60, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            rans.unpack_block(bytes(bad), table)
    one = rans.Table.of(np.array([7, 7, 7]))
    assert (rans.unpack_block(rans.pack_block(np.array([7, 7, 7]), np.array([1]), np.array([3]), one), one)[2] == 7).all()


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_keys(points, bits)
        assert sorted(keys.tolist()) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_sequences_are_full_or_powers_of_two():
    s = Sequences(16, 100)
    for doc, n in enumerate((5, 40, 1, 3, 10)):
        s.add(doc, np.arange(n, dtype="<u4") + 100 * doc)
    s.finish()
    sizes = defaultdict(int)
    for _, _, length, _, _, sequence, offset, _ in s.rows:
        assert offset == sizes[sequence]
        sizes[sequence] += length
    assert sorted(sizes.values(), reverse=True) == [16, 16, 16, 8, 2, 1] and min(sizes) == 100


def test_packing_awkward_rows(spark):
    rows = pack_along_curve(documents(spark), WORD, 1, length=64).collect()
    sequences, pieces = defaultdict(int), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences[r.sequence_id]
        sequences[r.sequence_id] += r.length
        assert zlib.crc32(r.token_ids) == r.ids_crc32
        pieces[r.doc_id].append(r)
    assert all(n <= 64 and n & (n - 1) == 0 for n in sequences.values())
    want = defaultdict(list)
    for i, t in ROWS:
        want[i].append(library_ids(WORD, t or "") + [1])
    assert set(pieces) == set(want)
    for i, docs in want.items():
        assert sum(r.length for r in pieces[i]) == sum(map(len, docs))
        if len(docs) == 1:
            ids = b"".join(r.token_ids for r in sorted(pieces[i], key=lambda r: r.start))
            assert np.frombuffer(ids, "<u4").tolist() == docs[0]
            assert {r.doc_tokens for r in pieces[i]} == {len(docs[0])}
    assert pack_along_curve(empty(spark), WORD, 1).isEmpty()
