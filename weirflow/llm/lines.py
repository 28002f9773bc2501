"""Line dedup by site-relative frequency: drop lines that stand on too large a share of a host's pages.

Built-in expressions only. Copies of a text are one page. Lines are counted by hash, one row per distinct line of a page, summed in each task
before the shuffle; a line's text is never moved. A host has at most (mean distinct lines per page / ratio) lines above
the ratio, so what meets its pages again is a short list per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import saved

#: A line is boilerplate if it stands on more than RATIO of its host's pages, and on LEAST pages at least.
RATIO, LEAST = 0.08, 3
#: Lists of boilerplate for so many hosts, of so many lines in all, are sent to all tasks; beyond that the join is a shuffle.
MOST_HOSTS, MOST_LINES = 100_000, 1_000_000


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(line)


def boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST
) -> DataFrame:
    """(host, lines): hashes of the lines that stand on more than ``ratio`` of the host's pages, and on ``least`` at least.

    Each different text of a host is a page, however many rows have it: copies of a document are no sign of boilerplate. All null texts of a host
    are one page, without lines. Blank lines and null hosts do not count.
    """
    own = F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), _key))
    pages = docs.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), _key(F.col(text)).alias("text"), own.alias("own"))
    pages = pages.dropDuplicates(["host", "text"])
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("own").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= least).join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST
) -> DataFrame:
    """``docs`` with the boilerplate lines of each row's host taken out of ``text``; all rows and columns are kept.

    Every occurrence of such a line goes, the rest keeps its order. A text all of whose lines go is empty; null stays null, a row
    with a null host stays as it is, and repeated rows are one page. An empty table gives an empty one.
    """
    found = saved(boilerplate(docs, host, text, ratio, least), "boilerplate")
    size = found.agg(F.count("*"), F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()
    few = size[0] <= MOST_HOSTS and size[1] <= MOST_LINES
    found = found.select(F.col("host").alias("_llm_host"), F.col("lines").alias("_llm_lines"))
    joined = docs.join(F.broadcast(found) if few else found, docs[host] == found["_llm_host"], "left")
    kept = F.array_join(F.filter(_lines(text), lambda x: ~F.array_contains(F.col("_llm_lines"), _key(x))), "\n")
    clean = F.when(F.col("_llm_lines").isNull(), F.col(text)).otherwise(kept)
    return joined.withColumn(text, clean).select(*docs.columns)


def changed_lengths(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, text, n_lines, n_kept) after ``drop_boilerplate``: the cleaned text and the numbers of lines before and after."""
    before = docs.select("doc_id", "text", "source", F.size(_lines("text")).cast("long").alias("n_lines"))
    after = drop_boilerplate(before, **limits)
    kept = F.when(F.col("text") == "", 0).otherwise(F.size(_lines("text"))).cast("long")
    return after.select("doc_id", "text", "n_lines", kept.alias("n_kept"))
