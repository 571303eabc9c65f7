"""Operators 6 to 9 and the pipeline on awkward rows, and every registered query of the subpackage."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from reelhouse.llm import licenses, line_frequency, permutation_index, queries, shared_files, warc_dict
from reelhouse.llm.permutation_index import nearest
from reelhouse.llm.words import words_of

from .edge_cases import LONG, NEAR, ROWS, documents, empty, prose, words

SF = "/root/testdata/sf0.001"


# --- 6: WARC ---------------------------------------------------------------------------
def pages(spark, rows):
    schema = "page_id long, url string, html string, digest string, payload string, first string, path string"
    return spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], schema).repartition(3)


BODY = "<p>" + "same body " * 20 + "</p>"
PAGES = [(1, "http://a/1", BODY), (2, "http://a/2", BODY), (2, "http://a/2", BODY), (3, None, BODY), (4, "http://b/\r\nX: y", "short"),
         (5, "http://b", "short"), (6, "http://c", None), (7, "http://c", ""), (None, "http://d", BODY),
         (8, "http://é", "<b>é 😀</b>\r\n\r\nHTTP/1.1 " * 30), (9, "u", "x" * 300_000)]
PAGES += [(100 + i, f"http://site/{i}", f"<html><head><title>{i}</title></head><body>{prose(60, i)}</body></html>") for i in range(80)]


def brute_pages(rows):
    full = [(i, (t or "").encode()) for i, _, t in rows]
    first = {}
    for i, b in full:
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, b in full:
        refers = first.get(b) if i is not None and first.get(b) != i else None
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    folder = shared_files.new_folder(spark, "warc-test")
    index = warc_dict.archive(pages(spark, PAGES), folder)
    got = warc_dict.read_archives(index).cache()
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == brute_pages(PAGES)
    texts = {r.page_id: r for r in got.filter("record_type = 'response'").collect()}
    assert bytes(texts[8].payload).decode() == PAGES[9][2] and texts[4].url == "http://b/%0D%0AX: y"
    got.unpersist()


def test_warc_files_are_dictionary_frame_then_records(spark):
    index = warc_dict.archive(pages(spark, PAGES), shared_files.new_folder(spark, "warc-test"))
    seen = Counter()
    for path in {r.path for r in index.collect()}:
        dictionary, begin = warc_dict.read_dictionary(path)
        assert dictionary[:4] == b"\x37\xa4\x30\xec" and begin == len(dictionary) + 8
        data = shared_files.read_range(path, begin, shared_files.file_size(path) - begin)
        for record in warc_dict.records_in(data, dictionary):   # read without the index
            seen[warc_dict.parse(record)[0]["WARC-Type"]] += 1
        with pytest.raises(ValueError):
            list(warc_dict.records_in(data[:-3], dictionary))
    assert sum(seen.values()) == len(PAGES) and seen["revisit"] == 3


def test_warc_small_and_empty(spark):
    few = warc_dict.read_archives(warc_dict.archive(pages(spark, PAGES[:3]), shared_files.new_folder(spark, "warc-test")))
    assert sorted(r.record_type for r in few.collect()) == ["response", "revisit", "revisit"]
    none = warc_dict.archive(pages(spark, PAGES[:1]).limit(0), shared_files.new_folder(spark, "warc-test"))
    assert warc_dict.read_archives(none).isEmpty()


# --- 7: nearest neighbours ------------------------------------------------------------------
def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, id string, vec string, block string, rank string, score string"
    return spark.createDataFrame([(i, v, *["clash"] * 5) for i, v in rows], schema).repartition(3)


def brute_nearest(rows, k=5):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()
                   and any(v) and len(v) == 8})
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good], dtype=np.float64)
    norms, out = np.sqrt((x * x).sum(axis=1)), []
    for q in sorted(set(ids[ids % 50 == 0].tolist())):
        s = (x * x[ids == q][0]).sum(axis=1) / (norms * norms[ids == q][0])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out += [(q, r + 1, int(ids[j]), s[j]) for r, j in enumerate(order)]
    return out


def test_nearest_small_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(90)]
    rows += [(1000 + i, rows[3][1]) for i in range(20)] + [rows[50]] + [(200, None), (250, [0.0] * 8), (300, [None] + [1.0] * 7)]
    rows += [(600, [3e38] * 8), (601, [2e38] * 7 + [1e38]), (602, [1e-36] * 6 + [2e-36] * 2), (350, [float("nan")] * 8), (400, [float("inf")] + [0.0] * 7), (450, []), (500, [1.0, 2.0]), (None, [1.0] * 8)]
    got = [tuple(r) for r in nearest(vectors(spark, rows), F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()]
    want = brute_nearest(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-12)
    assert nearest(vectors(spark, rows).limit(0), F.col("id") % 50 == 0).isEmpty()
    assert nearest(vectors(spark, rows[:1]), F.col("id") % 50 == 0).isEmpty()   # no candidate but itself


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pdf = table.toPandas().sort_values("vec_id")
    ids, x = pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = np.flatnonzero(ids % 50 == 0)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -2
    want = {(ids[a], ids[b]) for a, row in zip(q, np.argsort(-s, axis=1, kind="stable")[:, :5]) for b in row}
    got = {(r.query_id, r.vec_id) for r in queries.QUERIES["op7_permutation_index"](spark, "/root/testdata/sf0.1").collect()}
    assert len(got) == len(want) and len(got & want) >= 0.95 * len(want)


def test_recall_over_full_blocks(spark):
    n = permutation_index.BLOCK
    assert permutation_index.ranked_exactly(512, 5) / 512 == permutation_index.ranked_exactly(n, 5) / n
    r = np.random.default_rng(3)
    centres = r.normal(size=(150, 32))
    clustered = centres[r.integers(0, 150, 2 * n)] + r.normal(scale=0.3, size=(2 * n, 32))
    x = np.concatenate([clustered, r.normal(size=(n + 300, 32))]).astype(np.float32)
    ids = np.arange(len(x))
    table = spark.createDataFrame(pd.DataFrame({"vec_id": ids, "embedding": list(x)}), "vec_id long, embedding array<float>")
    x = x.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = np.flatnonzero(ids % 200 == 0)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -2
    fifth = dict(zip(ids[q], np.partition(s, -5, axis=1)[:, -5]))   # vectors as near as the fifth are as right
    got = nearest(table, F.col("id") % 200 == 0).collect()
    recall = sum(r.score >= fifth[r.query_id] - 1e-9 for r in got) / (5 * len(q))
    print("recall", recall, len(ids), len(q))
    assert len(got) == 5 * len(q) and recall >= 0.9


def test_pivots_are_different_vectors(spark):
    """A vector that a third of the rows repeat is one pivot, and its copies tie to smaller ids."""
    r = np.random.default_rng(5)
    x = np.concatenate([np.repeat(r.normal(size=(1, 16)), 150, axis=0), r.normal(size=(300, 16))])
    schema = "vec_id long, embedding array<double>, block string, ids string, score string"
    table = spark.createDataFrame([(i, v.tolist(), "c", "c", "c") for i, v in enumerate(x)], schema).repartition(3)
    rows = permutation_index.usable(table, "vec_id", "embedding")
    assert len(permutation_index.choose_pivots(rows, 1000)) == 301
    assert len(permutation_index.choose_pivots(rows, 40)) == 40
    got = [(row.rank, row.vec_id) for row in nearest(table, F.col("id") == 3).collect()]
    assert sorted(got) == [(1, 0), (2, 1), (3, 2), (4, 4), (5, 5)]
    blocks = permutation_index.build_index(rows.coalesce(1), permutation_index.choose_pivots(rows, 40), 16).collect()
    assert len(blocks) == 1 and len(blocks[0].ids) == 8 * 450 and len(blocks[0].vecs) == 8 * 16 * 301


def test_an_id_with_many_vectors_is_no_candidate_of_itself(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(40, 8))
    ids = [0] * 20 + list(range(1, 21))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = nearest(table.coalesce(1), F.col("id") == 0).collect()
    assert sorted(row["rank"] for row in got) == [1, 2, 3, 4, 5] and all(row.vec_id > 0 for row in got)
    assert nearest(table.filter("vec_id = 0").coalesce(1), F.col("id") == 0).isEmpty()


def test_only_opened_files_are_read(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(600, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = permutation_index.usable(table.coalesce(1), "vec_id", "embedding")
    base = permutation_index.choose_pivots(rows, 64)
    row = permutation_index.build_index(rows, base, 16).collect()[0]
    near = permutation_index.nearest_pivots(permutation_index._unit(x), base, 16)
    assert (near == np.argsort(-(permutation_index._unit(x) @ base.T), axis=1)[:, :16]).all()
    block = permutation_index.Block(row.asDict(), 16)
    order = near[7][:4]
    want = [sum(16 - abs(list(v).index(p) - own) for own, p in enumerate(order) if p in v) for v in near]
    assert block.footrules(order).tolist() == want and 0 in want


# --- 8: line frequency ------------------------------------------------------------------------
def test_base_statistics_by_brute_force(spark):
    got = line_frequency.line_frequency_rules(documents(spark)).collect()
    want = []
    for i, t in ROWS:
        t = t or ""
        w = t.encode().split()
        grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
        full = [x for x in t.split("\n") if x.encode().split()]
        stats = (i, len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), len(covered))
        want.append((*stats, len(w) < 50 or 2 * len(covered) > len(w)))
    cols = ["doc_id", *line_frequency.STATS, "base_failed"]
    assert sorted(([r[c] for c in cols] for r in got), key=str) == sorted(map(list, want), key=str)
    assert line_frequency.line_frequency_rules(empty(spark)).isEmpty()


def test_frequent_lines_and_depleted_documents(spark):
    head = "Subscribe  to our NEWSLETTER now"
    rows = []
    for i in range(40):   # 12 of 40 documents of the host have the line: 30 %
        rows.append((i, (head if i % 2 else head.lower()) + "\n" + prose(60, 100 + i) if i < 12 else prose(60, 100 + i)))
    rows.append((50, "\n".join([head] * 15)))           # little else: fails the base by repetition
    rows.append((51, head + " \n" + "\n".join(prose(6, 300 + k) for k in range(9))))
    schema = "doc_id long, text string, source string, kept string, line string"
    df = spark.createDataFrame([(i, t, "h", "clash", "clash") for i, t in rows], schema)
    other = spark.createDataFrame([(100 + i, head + "\n" + prose(60, 400 + i), "big", "c", "c") for i in range(9)], schema)
    out = {r.doc_id: r for r in line_frequency.line_frequency_rules(df.unionByName(other)).collect()}
    assert all(out[i].n_removed_words == (5 if i < 12 else 0) and out[i].kept for i in range(40))
    assert out[50].base_failed and not out[50].kept and out[51].n_removed_words == 5 and out[51].kept
    assert all(out[100 + i].n_removed_words == 0 for i in range(9))       # under min_docs
    kept = {r.doc_id: r for r in line_frequency.keep_good(df.unionByName(other)).collect()}
    assert set(kept) == set(out) - {50} and kept[3].text == prose(60, 103) and kept[3].line == "clash"
    assert kept[101].text.startswith(head)
    # a document that is mostly furniture is depleted though its base is good
    body = "\n".join(prose(9, 500 + k) for k in range(6))
    rows = [(i, body) for i in range(12)] + [(20 + i, prose(60, 600 + i)) for i in range(60)]
    df = spark.createDataFrame([(i, t, None, "", "") for i, t in rows], schema)
    out = {r.doc_id: r for r in line_frequency.line_frequency_rules(df).collect()}
    assert not out[0].base_failed and not out[0].kept and out[20].kept and out[0].n_removed_words == 54


def test_copies_of_a_clean_text_stay_for_the_near_duplicate_stage(spark):
    body, foot = "\n".join(prose(9, 500 + k) for k in range(6)), "Subscribe to our newsletter now"
    for host in (None, "h"):
        rows = [(i, body) for i in range(30)] + [(30 + i, f"{prose(60, 600 + i)}\n{foot}") for i in range(12)]
        rows += [(50 + i, prose(60, 700 + i)) for i in range(40)]   # 53 different texts, 12 of them with the line
        docs = documents(spark, rows).withColumn("source", F.lit(host).cast("string"))
        kept = line_frequency.keep_good(docs).cache()
        out = {r.doc_id: r.text for r in kept.collect()}
        assert set(out) == {i for i, _ in rows} and out[0] == body and out[30] == prose(60, 600)
        left = corpus_pipeline.near_duplicates(spark, kept, SF)
        assert {r.doc_id for r in left.collect()} == {0} | set(out) - set(range(30))
        kept.unpersist()
    by_row = {r.doc_id: r.kept for r in line_frequency.line_frequency_rules(docs).collect()}
    assert not by_row[0] and by_row[30]   # the operator alone counts rows, as its SQL does


# --- 9: licences ---------------------------------------------------------------------------------
def brute_licenses(rows, percent=80):
    import re
    known = [(kind, name, licenses.template_words(text), set(licenses.template_bigrams(text)))
             for kind, texts in licenses.TEMPLATES.items() for name, text in texts.items()]
    out = []
    for i, t in rows:
        w = [x for x in re.sub(r"[\W_]+", " ", (t or "").lower()).split(" ") if x]
        grams = [f"{a} {b}" for a, b in zip(w, w[1:])]
        found = []
        for kind, name, template, b in known:
            for s in range(len(grams)):
                if grams[s] in b:
                    g = set(grams[s:s + len(template) - 1])
                    c = len(g & b)
                    if 200 * c >= percent * (len(g) + len(b)):
                        found.append((-round(2 * c / (len(g) + len(b)), 6), -len(b), s, name, kind, c, len(g), w[s:s + len(template)]))
        for m in found:
            if not any(o[:5] < m[:5] and o[2] < m[2] + len(m[7]) and m[2] < o[2] + len(o[7]) for o in found):
                out.append((i, m[2], len(m[7]), m[3], m[4], m[5], m[6], -m[1], -m[0], " ".join(m[7])))
    return sorted(out, key=str)


def test_licences(spark):
    mit, apache, body = licenses.NOTICES["MIT"], licenses.NOTICES["Apache-2.0"], licenses.TEXTS
    commented = "\n".join(" * " + x.strip() for x in licenses.HEADERS["Apache-2.0"].split("\n"))
    edited = body["MIT"].replace("Software", "Program").replace("to deal in", "to handle").replace("FREE", "no")
    rows = ROWS + [
        (30, mit.upper() + "\n\n"), (31, "* " + apache.replace(" ", "   ") + " *"), (32, f"x {mit} y z"), (33, mit + " " + LONG),
        (34, "released under\nthe mit license"), (None, mit), (30, mit), (35, "a " * 3000 + mit),
        (36, prose(50, 90) + "\nThis file is released under\n# the MIT License. See there.\n" + prose(50, 91)),
        (37, f"/*\n{commented}\n */\n" + prose(60, 92)), (38, "Copyright someone\n\n" + body["BSD-3-Clause"]),
        (39, body["BSD-2-Clause"]), (40, edited), (41, f"{mit} {apache} {mit} {mit}"), (42, body["MIT"][:1100]),
        (43, body["MIT"][:400]), (44, "// SPDX-License-Identifier: BSD-3-Clause\n" + prose(30, 93)),
        (45, "the license of the software and the copyright of the holders " * 40), (46, licenses.HEADERS["GPL-3.0"] + body["ISC"]),
        (47, licenses.HEADERS["GPL-2.0"]), (48, " ".join([mit, "and"] * 700))]
    plan = licenses.license_matches(documents(spark, rows).select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Join", "Exchange")) and plan.count("split(") == 1
    got = licenses.license_matches(documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_licenses(rows)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: r.start):
        found[r.doc_id].append((r.license, r.kind))
    assert found[30] == [("MIT", "notice")] * 2 and found[34] == found[36] == found[32] == found[None] == [("MIT", "notice")]
    assert found[37] == [("Apache-2.0", "header")] and found[38] == [("BSD-3-Clause", "text")]
    assert found[39] == [("BSD-2-Clause", "text")] and found[40] == found[42] == [("MIT", "text")] and 43 not in found
    assert found[41] == [("MIT", "notice"), ("Apache-2.0", "notice"), ("MIT", "notice"), ("MIT", "notice")]
    assert found[44] == [("BSD-3-Clause", "tag")] and 45 not in found and len(found[48]) == 700
    assert found[46] == [("GPL-3.0", "header"), ("ISC", "text")] and found[47] == [("GPL-2.0", "header")]
    assert licenses.license_matches(empty(spark)).isEmpty()


def test_licences_of_own_templates(spark):
    rows = [(1, "one two three four five six"), (2, "zero one two THREE, four\nfive six"), (3, "one three two")]
    own = {"house": {"A": "one two three four", "B": "one two three four five six", "none": "single"}}
    got = licenses.license_matches(documents(spark, rows), own).collect()
    assert sorted((r.doc_id, r.start, r.license, r.run) for r in got) == [
        (1, 0, "B", "one two three four five six"), (2, 1, "B", "one two three four five six")]
    with pytest.raises(ValueError):
        licenses.license_matches(documents(spark, rows), {"house": {"none": "single", "empty": " - "}})


# --- the pipeline and the registered queries ----------------------------------------------------
def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Each stage judged on its own input, over all rows."""
    from .test_dedup import brute_components, brute_lines, brute_windows

    rows = [(i, t) for i, t in ROWS if i != 7 and i is not None] + [(40, LONG + " " + prose(70, 41)), (41, NEAR)]
    rows += [(50 + k, prose(90, 700 + k)) for k in range(8)]
    docs, steps = documents(spark, rows), []
    for name, fn in corpus_pipeline.STAGES:
        docs = fn(spark, docs, SF).cache()
        steps.append(docs)
    out = [sorted((r.doc_id, r.text) for r in s.collect()) for s in steps[:4]]
    assert all(s.columns == documents(spark, rows).columns for s in steps[:4])
    verdict = {r.doc_id: r.kept for r in line_frequency.line_frequency_rules(documents(spark, rows)).collect()}
    assert [i for i, _ in out[0]] == sorted(i for i, _ in rows if verdict[i])
    assert out[1] == sorted((i, t) for i, _, _, t in brute_lines(out[0]))
    keep = {i for i, _, c in brute_components(out[1]) if i == c}
    assert out[2] == [x for x in out[1] if x[0] in keep]
    assert [(i, b" ".join(words(t))) for i, t in out[3]] == sorted((i, k) for i, _, _, k in brute_windows(out[2], 20))
    assert all(r.n_chars == len(r.text) for s in (steps[0], steps[1], steps[3]) for r in s.collect())
    packed = defaultdict(int)
    for r in steps[4].collect():
        packed[r.doc_id] += r.length
    assert set(packed) == {i for i, _ in out[3]}
    for s in steps:
        s.unpersist()


def test_pipeline_on_an_empty_table(spark):
    docs = empty(spark)
    for _, fn in corpus_pipeline.STAGES:
        docs = fn(spark, docs, SF)
    assert docs.isEmpty()


def test_entry_has_all_queries():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    cur = duck.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, cur.fetchall()))


def test_words_match_python_split():
    texts = [t or "" for _, t in ROWS]
    w = words_of(pa.array(texts))
    flat = [w.data[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
    assert flat == [x for t in texts for x in words(t)]
