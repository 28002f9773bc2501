"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of characters, trained on trusted text.

``judge_quality`` trains and asks the model of ``charmodel``: characters as they are, tables sharded by n-gram, joins. A document is rejected
if its perplexity lies above a quantile of that of trusted documents of its language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm import charmodel
from weirflow.llm.common import saved

#: Perplexity is taken over at least so many characters; what a short text lacks counts as average text.
LEAST_CHARS = 100
#: A document is rejected above FACTOR times the QUANTILE of its language's trusted perplexities.
QUANTILE, FACTOR = 0.99, 1.1
#: So many trusted ids, or languages, are sent to all tasks; beyond that their join is a shuffle.
MOST_IDS, MOST_LANGS = 4_000_000, 10_000


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the documents whose every label is good quality and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    judged = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
    return judged.where("good").select("doc_id")


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with these doc_ids. The ids are sent to all tasks only while they are few."""
    few = ids.limit(MOST_IDS + 1).count() <= MOST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def judge_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, factor: float = FACTOR) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, lang and others) with ``perplexity``, ``threshold`` and ``accepted``.

    Trusted text is that of documents labelled good and not toxic, all of it. The threshold is ``factor`` times the ``quantile`` of
    trusted perplexities in the row's language; a language without trusted text, a null one too, takes the largest
    threshold there is. Null and empty texts have the average perplexity and are accepted. Without any trusted
    text nothing can be judged: perplexity and threshold are null and all is accepted. Repeated rows are judged
    each; columns of the three names are replaced.
    """
    docs = docs.drop("perplexity", "threshold", "accepted")
    columns = docs.columns
    trusted = _marked(docs.select("doc_id", "text", "lang"), trusted_ids(labels))
    model = charmodel.train(trusted)
    if model is None:
        nothing = F.lit(None).cast("double")
        return docs.withColumns({"perplexity": nothing, "threshold": nothing, "accepted": F.lit(True)})
    docs = charmodel.in_blocks(docs)
    answers = charmodel.look_up(docs, model)
    trusted = _marked(docs.select("doc_id", "text", "lang", "_llm_block"), trusted_ids(labels))
    limits = charmodel.score(trusted, answers, model, LEAST_CHARS).groupBy("lang")
    limits = limits.agg((F.percentile_approx("perplexity", quantile, 10_000) * factor).alias("threshold"))
    limits = saved(limits, "perplexity-limits")
    widest = limits.agg(F.max("threshold")).first()[0]
    few = limits.limit(MOST_LANGS + 1).count() <= MOST_LANGS
    limits = limits.where("lang is not null")
    judged = charmodel.score(docs, answers, model, LEAST_CHARS).join(F.broadcast(limits) if few else limits, "lang", "left")
    judged = judged.withColumn("threshold", F.coalesce("threshold", F.lit(widest)))
    return judged.select(*columns, "perplexity", "threshold", (F.col("perplexity") <= F.col("threshold")).alias("accepted"))
