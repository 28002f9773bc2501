"""From raw documents to packed training sequences: the stages, and ``run`` over a folder of tables.

Each stage takes (spark, docs, sf_dir) and returns a table: the columns of ``docs`` for all stages but the last, which returns
one row per piece of a document in its training sequence. Nulls, empty texts, repeated rows, empty tables and extra
columns have the results that the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.common import saved, table
from weirflow.llm.jaccard import keep_one_of_each
from weirflow.llm.lines import drop_boilerplate
from weirflow.llm.packing import pack_documents
from weirflow.llm.perplexity import judge_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the perplexity model accepts."""
    return judge_quality(docs, table(spark, sf_dir, "labels")).where("accepted").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; ``n_chars`` follows the text.

    Copies of a text count as one page: they are the next stage's business, and must not lose their lines here.
    """
    clean = drop_boilerplate(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return clean.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more: the smallest doc_id."""
    return keep_one_of_each(docs, words=5, num=4, den=5)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte of every document, in sequences of the permitted lengths."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("packing", packing)]

#: No SQL for the whole run: its model and packing cannot be put in SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
