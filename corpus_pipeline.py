"""Corpus pipeline over ``documents``: quality rules, line dedup, near duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``docs`` (the last one:
packed pieces); ``run`` writes each result as Parquet in the shared folder and reads it again for
the next.  Where a stage changes a text, ``n_chars`` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.chunks import free_name
from reelhouse.llm.hilbert_pack import pack_along_curve
from reelhouse.llm.line_dedup import remove_repeated_lines
from reelhouse.llm.line_frequency import keep_good
from reelhouse.llm.ngram_join import jaccard_components
from reelhouse.llm.queries import tokenizer_path
from reelhouse.llm.substring_dedup import remove_repeated_windows

END_ID = 1
SEQUENCE_TOKENS = 2048
KEPT_PIECES = 300_000   # workers live on between stages: less memory than when packing alone


def _like(out: DataFrame, docs: DataFrame) -> DataFrame:
    """``out`` with the columns of ``docs``, n_chars counted anew."""
    return out.select(*[F.coalesce(F.length("text"), F.lit(0)).cast(t).alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c, t in docs.dtypes])


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: rejected documents go; lines above their host's limit are removed from the rest."""
    return _like(keep_good(docs), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: lines covered by a repeated three-line window go, but for its first occurrence."""
    return _like(remove_repeated_lines(docs, carry=_carried(docs)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of linked documents the one with the smallest id stays (rows that
    repeat an id stay or go together)."""
    key = free_name(docs, "kept_id")
    first = (jaccard_components(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .select(F.col("doc_id").alias(key)).distinct())
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col(key)), "left_semi")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: words covered by a 20-word window that stands earlier go."""
    return _like(remove_repeated_windows(docs, carry=_carried(docs)), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: what is left, as pieces of sequences along the curve."""
    return pack_along_curve(docs, tokenizer_path("word_bpe_49k.json"), END_ID, SEQUENCE_TOKENS,
                            kept_pieces=KEPT_PIECES).drop("token_ids")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("substring dedup", substring_dedup), ("packing", packing)]
#: Packing works on the token ids of a BPE, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    from reelhouse.llm.chunks import stage

    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, fn) in enumerate(STAGES):
        docs = fn(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
