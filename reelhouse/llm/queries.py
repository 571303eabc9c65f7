"""Registered queries of the operators, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def decimal_sha256(ids: str) -> Column:
    """Hash of an array of token ids written as decimals joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)


_WINDOWS_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda s: s <> '') AS words
           FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS body
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w) x),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS k
                                 FROM win) t WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
n_gone AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.p) AS body
         FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w) t
         LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.p = t.p WHERE gone.p IS NULL GROUP BY t.doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_gone.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.body, '')) AS kept_sha256
FROM w LEFT JOIN n_gone ON n_gone.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id"""


@register("op10_substring_dedup", _WINDOWS_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.substring_dedup import remove_repeated_windows

    return remove_repeated_windows(table(spark, sf_dir, "documents"), digest="kept_sha256").drop("text")


_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda s: s <> '') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS gram
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id
           GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
root AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(root.low, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN root ON root.a = w.doc_id"""


@register("op5_ngram_jaccard_join", _JACCARD_SQL)
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op3_rans_token_ids")
def op3_rans_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm import rans, shared_files

    files = rans.write_ids(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 2,
                           shared_files.new_folder(spark, "rans"))
    return rans.read_ids(files, with_ids=False).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@register("op1_hilbert_packing")
def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.hilbert_pack import pack_along_curve

    return pack_along_curve(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1).drop("token_ids")


@register("op2_tree_bpe")
def op2_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.tree_bpe import encode_documents

    out = encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), decode=True)
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                      decimal_sha256("token_ids").alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def _line_dedup_sql() -> str:
    from reelhouse.llm.line_dedup import oracle_sql

    return oracle_sql()


@register("op4_line_windows", _line_dedup_sql())
def op4_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.line_dedup import remove_repeated_lines

    out = remove_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def _license_sql() -> str:
    from reelhouse.llm.licenses import oracle_sql

    return oracle_sql()


@register("op9_license_dice", _license_sql())
def op9_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.licenses import license_matches

    return license_matches(table(spark, sf_dir, "documents"))


@register("op7_permutation_index")
def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.permutation_index import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


_PAGES_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 100"""


@register("op6_warc_dictionary", _PAGES_SQL)
def op6_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm import shared_files, warc_dict

    index = warc_dict.archive(table(spark, sf_dir, "pages"), shared_files.new_folder(spark, "warc"))
    return warc_dict.read_archives(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _frequency_sql() -> str:
    from reelhouse.llm.line_frequency import oracle_sql

    return oracle_sql()


@register("op8_line_frequency", _frequency_sql())
def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.line_frequency import line_frequency_rules

    return line_frequency_rules(table(spark, sf_dir, "documents")).drop("n_removed_words", "removed_lines")


def _search_sql() -> str:
    from reelhouse.llm.lexical_search import oracle_sql

    return oracle_sql()


@register("op11_automaton_search", _search_sql())
def op11_automaton_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.lexical_search import ranked_search

    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


def _trie_sql() -> str:
    from reelhouse.llm.conversation_trie import oracle_sql

    return oracle_sql()


@register("op13_block_trie", _trie_sql())
def op13_block_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.conversation_trie import prefix_trie, regrafted

    return prefix_trie(*regrafted(table(spark, sf_dir, "conversations")))


def _suffix_sql() -> str:
    from reelhouse.llm.suffix_dedup import oracle_sql

    return oracle_sql()


@register("op12_interval_expansion", _suffix_sql())
def op12_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelhouse.llm.suffix_dedup import remove_repeated_bytes

    out = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
