"""The registered queries of this package, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import bpe, lines, merkle, urls
from weirflow.llm.common import table
from weirflow.llm.fingerprints import compare_with_next
from weirflow.llm.jaccard import jaccard_groups
from weirflow.llm.packing import pack_documents
from weirflow.llm.oracle import ORACLE  # noqa: F401  (registered with the queries)
from weirflow.llm.page_text import extract_text
from weirflow.llm.perplexity import judge_quality
from weirflow.llm.prefix_trie import prefix_trie
from weirflow.llm.toxicity import judge_toxicity
from weirflow.llm.vectors import near_vectors
from weirflow.llm.warc import archive_pages


def op1_document_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    return compare_with_next(table(spark, root, "documents"))


def op2_byte_level_bpe(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, root, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    return extract_text(table(spark, root, "pages"))


def op4_ngram_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_groups(table(spark, root, "documents"), words=4, num=85, den=100)


def op5_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    return pack_documents(table(spark, root, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near_vectors(table(spark, root, "embeddings"), cosine=0.98)


def op7_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    return lines.changed_lengths(table(spark, root, "documents"))


def op8_url_filters(spark: SparkSession, root: str) -> DataFrame:
    """Outcomes are the labels whose doc_id is the page's id: bad if of low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    outcomes = table(spark, root, "labels").select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))
    return urls.filter_urls(table(spark, root, "pages"), outcomes)


def op9_warc(spark: SparkSession, root: str) -> DataFrame:
    return archive_pages(table(spark, root, "pages"))


def op10_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    judged = judge_quality(table(spark, root, "documents").select("doc_id", "text", "lang"), table(spark, root, "labels"))
    return judged.select("doc_id", "lang", "perplexity", "threshold", "accepted")


def op11_toxicity(spark: SparkSession, root: str) -> DataFrame:
    """Held out are the rows whose doc_id has a CRC-32 of 2 modulo 4: their labels are not read."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    outcomes = table(spark, root, "labels").where(fold != 2).select("doc_id", "toxic")
    judged = judge_toxicity(table(spark, root, "documents").select("doc_id", "text"), outcomes)
    return judged.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op12_conversation_prefix_trie(spark: SparkSession, root: str) -> DataFrame:
    return prefix_trie(table(spark, root, "conversations"))


def op13_merkle_dataset_manifest(spark: SparkSession, root: str) -> DataFrame:
    return merkle.verify(table(spark, root, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_document_fingerprints,
        op2_byte_level_bpe,
        op3_html_extraction,
        op4_ngram_jaccard_join,
        op5_best_fit_packing,
        op6_embedding_near_dedup,
        op7_line_dedup,
        op8_url_filters,
        op9_warc,
        op10_quality_classifier,
        op11_toxicity,
        op12_conversation_prefix_trie,
        op13_merkle_dataset_manifest,
    )
}


