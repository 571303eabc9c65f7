"""Operators 4, 5 and 10 against brute force on awkward rows."""

import random

import pytest

from reelhouse.llm.components import connected_components
from reelhouse.llm.line_dedup import remove_repeated_lines
from reelhouse.llm.ngram_join import jaccard_components
from reelhouse.llm.substring_dedup import remove_repeated_windows
from reelhouse.llm.words import window_hashes, words_of

from .edge_cases import ROWS, documents, empty, prose, words


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(r)))


def brute_windows(rows, size):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w, gone = words(text), set()
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            if key in seen:
                gone |= set(range(k, k + size))
            seen.add(key)
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window, base", [(20, 10), (20, 5), (8, 8), (40, 10)])
def test_repeated_windows(spark, window, base):
    got = remove_repeated_windows(documents(spark), window=window, base_words=base, chunk_bytes=20_000).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, b" ".join(words(r.text))) for r in got]
    assert by_id(got) == by_id(brute_windows(ROWS, window))


def test_windows_keep_layout_and_columns(spark):
    rows = [(1, "a b\nc  d e\tf"), (2, "x\n\na b\nc  d e\ty\nz")]
    got = {r.doc_id: r for r in remove_repeated_windows(documents(spark, rows), window=4, base_words=2,
                                                        carry=["lang", "n_chars"]).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "x\n\ny\nz" and got[2].lang == "en"
    with pytest.raises(ValueError):
        remove_repeated_windows(documents(spark), carry=["text"])
    with pytest.raises(ValueError):
        remove_repeated_windows(documents(spark), window=20, base_words=7)


def test_empty_tables(spark):
    assert remove_repeated_windows(empty(spark)).isEmpty()
    assert remove_repeated_lines(empty(spark)).isEmpty()
    assert jaccard_components(empty(spark)).isEmpty()
    nothing = [(1, None), (2, ""), (3, " ")]
    assert remove_repeated_windows(documents(spark, nothing)).count() == 3
    assert sorted(tuple(r) for r in jaccard_components(documents(spark, nothing)).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def brute_components(rows, size=5, percent=75):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for _, text in rows:
        w = [x.translate(lower) for x in words(text)]
        n = min(size, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return out


def test_components(spark):
    assert by_id(map(tuple, jaccard_components(documents(spark), chunk_bytes=20_000).collect())) == by_id(brute_components(ROWS))


def test_large_near_copy_group_and_chains(spark):
    """Near copies on both sides of the threshold, so that pivots alone do not find all links."""
    rng = random.Random(11)
    base, rows = prose(160, 12).split(), []
    for i in range(150):
        copy = list(base)
        for k in rng.sample(range(len(base)), rng.randint(0, 9)):
            copy[k] = f"edit{rng.randint(0, 40)}"
        rows.append((i, " ".join(copy[:len(copy) - rng.randint(0, 12)])))
    for i in range(150, 180):   # a chain: each linked to the next only
        rows.append((i, " ".join(base[3 * (i - 150):3 * (i - 150) + 60])))
    rows += [(200 + k, "one two three") for k in range(3)] + [(210, "one two three four")]
    assert by_id(map(tuple, jaccard_components(documents(spark, rows)).collect())) == by_id(brute_components(rows))


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (5, 4), (7, 7), (9, 10), (None, 3), (9, 10)] + [(i, i + 1) for i in range(20, 60)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 9, 10: 9, **{i: 20 for i in range(20, 61)}}


def brute_lines(rows, size=3):
    blanks, seen, out = " \t\n\x0b\f\r", set(), {}
    for i, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = text.split("\n")
        full = [(k, x.strip(blanks)) for k, x in enumerate(lines) if x.strip(blanks)]
        gone = set()
        for k in range(len(full) - size + 1):
            key = tuple(x for _, x in full[k:k + size])
            if key in seen:
                gone |= {p for p, _ in full[k:k + size]}
            seen.add(key)
        out[i, text] = (i, len(full), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return [out.get((i, t), (i, 0, 0, None)) for i, t in rows]


def test_line_windows(spark):
    got = remove_repeated_lines(documents(spark), carry=["lang", "source"]).drop("lang", "source")
    assert by_id(map(tuple, got.collect())) == by_id(brute_lines(ROWS))
    text = {r.doc_id: r.text for r in got.collect()}
    assert text[17] == "l1 a\nl2 b\nl3 c\nl4 d\n\nl5 e" and text[20] == "new line"


def test_line_windows_run_no_python(spark):
    plan = remove_repeated_lines(documents(spark).select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_words_and_window_hashes():
    import pyarrow as pa

    texts = ["a b", "b", None, "", "c" * 3_000_000 + " d", "A b", "é É", "a\x1cb\x85c"]
    w = words_of(pa.array(texts))
    assert w.n_words.tolist() == [2, 1, 0, 0, 2, 2, 2, 1]
    h, low = w.hashes(), w.hashes(lower=True)
    assert h[1] == h[2] == h[6] and h[0] != h[5] and low[0] == low[5] and low[7] != low[8]
    assert len(set(h.tolist())) == 8
    for n in (1, 2, 3, 5, 20):
        x = words_of(pa.array(["p q r s t u v w x y z a b c d e f g h i j k p q r s t u v w x y z a b c d e f g h i j k"]))
        keys = window_hashes(x.hashes(), n)
        assert len(keys) == len(x.starts) - n + 1
        assert all((keys[a] == keys[a + 22]) for a in range(len(keys) - 22))
        assert len(set(keys.tolist())) == 22


def straddling_family(members, n_words, seed):
    """Copies of one text that is not among them, each with edits of its own: their pairs lie around the threshold."""
    r = random.Random(seed)
    base = [f"w{r.randint(0, 10**9)}" for _ in range(n_words)]
    rows = []
    for i in range(members):
        w = list(base)
        for k in range(0, n_words, n_words // max(1, n_words // 100 + i % (n_words // 50))):
            w[r.randint(k, min(n_words - 1, k + 9))] = f"own{r.randint(0, 10**9)}"
        rows.append((i, " ".join(w)))
    return rows


def test_family_around_the_threshold(spark):
    rows = straddling_family(45, 300, 3) + straddling_family(12, 1500, 4)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(documents(spark, rows)).collect()}
    want = brute_components(rows)
    assert got == {r[0]: (r[1], r[2]) for r in want} if not isinstance(want, dict) else got == want


def test_candidates_do_not_grow_with_the_square_of_a_family(spark, monkeypatch):
    from reelhouse.llm import ngram_join
    tested, verified = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, reps, percent: (tested.append(pairs.count()), verified(pairs, reps, percent))[1])
    counts = []
    for members in (60, 300):
        tested.clear()
        ngram_join.jaccard_links(documents(spark, straddling_family(members, 300, 5)))
        counts.append(sum(tested))
    print("pairs tested", counts)
    assert counts[1] <= 7 * counts[0]
