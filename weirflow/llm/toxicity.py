"""Toxicity of documents from the words they mean, after ``deobfuscation`` has read what was written to hide them.

1. All units of all texts are counted; the doubtful ones are decoded under a character model of the plain ones.
2. Of learning documents that are copies or near copies of each other, by equal min-hashes of their five-word shingles, one is learnt from: else all
   words of a toxic document with many copies would tell of toxicity.
3. For each word, the learning documents that have it are counted by label. A word is evidence if it is TIMES as frequent among toxic ones and
   the likelihood ratio of both rates passes a bound that grows with the number of words tried. The first bound keeps out words that are
   common everywhere: many labels tell their rates apart, however little they differ, and a long text has all of them.
4. A text's evidence is the sum of the logarithms of those ratios over its different words. A logistic curve over evidence, fitted to all
   learning documents, makes it the probability of label 1.

Texts are never shuffled: tasks read them with the spellings of the evidence at hand, and hand on one short row per hit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import batch, chunks, saved, ship
from weirflow.llm.deobfuscation import batches_of, is_doubtful, is_plain, restore, train, units, vocabulary
from weirflow.llm.shingles import mix, shingle_sets

#: A text is called toxic from this score on.
THRESHOLD = 0.3
#: A word of evidence is so many times as frequent among toxic documents as among others.
TIMES = 4.0
#: The likelihood ratio statistic of a word of evidence: LEAST, and twice the logarithm of the words tried.
LEAST = 2.0
#: Evidence above MOST counts as MOST; the curve is fitted to steps of STEP.
MOST, STEP = 40.0, 0.05
#: Words of a shingle, and min-hashes of a text: documents of one label that agree in any of these count once.
WORDS, HASHES = 5, 4
#: So many spellings, or labelled ids, are sent to all tasks; beyond that they are met by a shuffle join.
MOST_SPELLINGS, MOST_IDS = 500_000, 4_000_000


def text_key() -> Column:
    """Equal texts have equal evidence, so their rows need no identity. Null counts as empty."""
    return F.md5(F.coalesce("text", F.lit("")))


def without_copies(docs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``outcomes`` (doc_id, toxic) without those documents of which a copy or near copy with a smaller doc_id has the same label."""
    ship(docs.sparkSession)
    seeds = np.random.default_rng(11).integers(1, 2**63, HASHES, dtype=np.uint64)
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("hashes", pa.list_(pa.int64()))])

    def signed(parts):
        for part in parts:
            found = []
            for texts in chunks(part.column(1)):
                for keys in shingle_sets(texts, WORDS):
                    found.append([int(mix(keys ^ seed).min().view(np.int64)) for seed in seeds] if len(keys) else [])
            yield batch(schema, part.column(0), part.column(2), found)

    known = learning(docs, outcomes, "doc_id").mapInArrow(signed, "doc_id long, toxic int, hashes array<long>")
    known = saved(known.select("doc_id", "toxic", F.posexplode("hashes").alias("i", "hash")), "label-hashes")
    first = known.groupBy("toxic", "i", "hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = known.join(first, ["toxic", "i", "hash"]).where("doc_id > first").select("doc_id").distinct()
    return outcomes.join(again, "doc_id", "left_anti")


def learning(docs: DataFrame, outcomes: DataFrame, *columns: str) -> DataFrame:
    """(*columns, text, toxic): the documents with an outcome (doc_id, toxic 0/1)."""
    few = outcomes.limit(MOST_IDS + 1).count() <= MOST_IDS
    return docs.select("doc_id", "text").join(F.broadcast(outcomes) if few else outcomes, "doc_id").select(*columns, "text", "toxic")


def units_by_label(learned: DataFrame) -> DataFrame:
    """(unit, toxic, clean): in how many documents of each label a unit stands."""
    ship(learned.sparkSession)

    def count(parts):
        for part in batches_of(parts):
            row, found = units(part.column("text"))
            coded = found.dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            pairs = np.unique(row * (len(coded.dictionary) + 1) + code)
            row, code = np.divmod(pairs, len(coded.dictionary) + 1)
            label = part.column("toxic").to_numpy()[row]
            total = np.bincount(code, minlength=len(coded.dictionary))
            toxic = np.bincount(code, label, len(coded.dictionary)).astype(np.int64)
            names = coded.dictionary.cast(pa.string())
            yield pa.record_batch([names, pa.array(toxic), pa.array(total - toxic)], ["unit", "toxic", "clean"])

    counted = learned.select("text", F.col("toxic").cast("int").alias("toxic"))
    counted = counted.mapInArrow(count, "unit string, toxic long, clean long")
    return counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _of_words(spelled: DataFrame, meant: DataFrame) -> DataFrame:
    """``spelled`` (unit, ...) with one row for each different word that a unit means: itself unless ``meant`` has it."""
    words = F.array_distinct(F.split(F.coalesce("meant", "unit"), " "))
    return spelled.join(meant, "unit", "left").withColumn("word", F.explode(words)).drop("meant").where("word != ''")


def evidence(by_word: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(word, weight) of ``by_word`` (word, toxic, clean): the words that tell of label 1."""
    tried = by_word.count()
    t, c = F.col("toxic"), F.col("clean")
    # Expected hits if both labels had the word equally often.
    share = (t + c) / float(n_toxic + n_clean)
    part = lambda seen, n: F.when(seen > 0, seen * F.log(seen / (n * share))).otherwise(0.0)
    rest = lambda seen, n: F.when(n - seen > 0, (n - seen) * F.log((n - seen) / (n * (1 - share)))).otherwise(0.0)
    ratio = 2 * (part(t, n_toxic) + part(c, n_clean) + rest(t, n_toxic) + rest(c, n_clean))
    weight = F.log((t + 0.5) / (n_toxic + 1.0)) - F.log((c + 0.5) / (n_clean + 1.0))
    found = by_word.withColumns({"ratio": ratio, "weight": weight})
    return found.where((F.col("weight") > math.log(TIMES)) & (F.col("ratio") > LEAST + 2 * math.log(max(tried, 1)))).select("word", "weight")


def spellings(words: DataFrame, meant: DataFrame) -> DataFrame:
    """(unit, word, weight): every way in which a word of evidence stands in the corpus."""
    other = meant.withColumn("word", F.explode(F.array_distinct(F.split("meant", " ")))).where("word != unit")
    own = words.select(F.col("word").alias("unit"), "word", "weight")
    return own.unionByName(other.join(words, "word").select("unit", "word", "weight"))


def text_evidence(docs: DataFrame, spelled: DataFrame) -> DataFrame:
    """(key, evidence) of the texts that have any of the spellings; each word of a text counts once."""
    ship(docs.sparkSession)
    few = spelled.select("unit").distinct().limit(MOST_SPELLINGS + 1)
    wanted = few.collect() if few.count() <= MOST_SPELLINGS else None
    wanted = None if wanted is None else pa.array([r.unit for r in wanted], pa.large_string())

    def hits(parts):
        for part in batches_of(parts):
            row, found = units(part.column("text"))
            if wanted is not None:
                among = pc.is_in(found, value_set=wanted)
                row, found = row[among.to_numpy(zero_copy_only=False)], found.filter(among)
            key = part.column("key").take(pa.array(row))
            pairs = pa.table({"key": key, "unit": found.cast(pa.string())})
            yield from pairs.group_by(["key", "unit"]).aggregate([]).select(["key", "unit"]).to_batches(65_536)

    found = docs.select(text_key().alias("key"), "text").mapInArrow(hits, "key string, unit string")
    found = found.join(F.broadcast(spelled) if wanted is not None else spelled, "unit").select("key", "word", "weight").distinct()
    return found.groupBy("key").agg(F.sum("weight").alias("evidence"))


def curve(steps: list[tuple[float, int, int]], pull: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope of the logistic curve through (evidence, toxic, clean), by Newton's method. The slope is not negative."""
    x = np.array([s[0] for s in steps], float)
    n, k = np.array([s[1] + s[2] for s in steps], float), np.array([s[1] for s in steps], float)
    # One document of each label is added where nothing is known, so that no curve is infinitely steep.
    share = (k.sum() + 0.5) / (n.sum() + 1.0)
    w = np.array([math.log(share / (1 - share)), 0.0])
    features = np.stack([np.ones_like(x), x])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ features, -40, 40)))
        slope = features @ (k - n * p) - pull * np.array([0.0, w[1]])
        bend = (features * (n * p * (1 - p))) @ features.T + np.diag([1e-9, pull + 1e-9])
        step = np.linalg.solve(bend, slope)
        w = w + np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), max(0.0, float(w[1]))


def judge_toxicity(docs: DataFrame, outcomes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` (doc_id, text and others) with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    ``outcomes`` (doc_id, toxic) are the labels to learn from. Several outcomes of one document count as one, 1 if any is; null ids and
    nulls do not count, nor do ids without a document; copies and near copies of one label count once. The character model and the spellings come from all texts of ``docs``. A text without evidence, an empty or null
    one too, has the score that such texts have among the learning documents. Repeated rows are learnt from and scored each; columns
    of the two names are replaced. Without any outcome all scores are 0. An empty table gives no rows.
    """
    docs = docs.drop("score", "predicted")
    outcomes = outcomes.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    docs_of_labels = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    outcomes = saved(without_copies(docs_of_labels, outcomes), "label-firsts")
    learned = learning(docs_of_labels, outcomes)
    n = learned.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") != 1).alias("clean")).first()
    if not n.toxic + n.clean:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    counted = saved(vocabulary(docs), "unit-counts")
    model = train(counted.where(is_plain(F.col("unit"))))
    meant = saved(restore(counted.where(is_doubtful(F.col("unit"))).select("unit"), model), "unit-meanings")
    by_word = _of_words(units_by_label(learned), meant).groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # A document that has a word in two spellings was counted for each.
    whole = {"toxic": F.least("toxic", F.lit(n.toxic)), "clean": F.least("clean", F.lit(n.clean))}
    words = saved(evidence(saved(by_word.withColumns(whole), "word-labels"), n.toxic, n.clean), "word-evidence")
    found = saved(text_evidence(docs, saved(spellings(words, meant), "word-spellings")), "text-evidence")

    seen = learned.select(text_key().alias("key"), "toxic").join(found, "key", "left")
    step = F.round(F.least(F.coalesce("evidence", F.lit(0.0)), F.lit(MOST)) / STEP) * STEP
    # At most MOST / STEP rows come to the driver.
    steps = seen.groupBy(step.alias("x")).agg(F.count_if(F.col("toxic") == 1).alias("k"), F.count_if(F.col("toxic") != 1).alias("m")).collect()
    begin, slope = curve([(r.x, r.k, r.m) for r in steps])
    judged = docs.withColumn("_llm_key", text_key()).join(found.withColumnsRenamed({"key": "_llm_key", "evidence": "_llm_evidence"}), "_llm_key", "left")
    score = 1 / (1 + F.exp(-(begin + slope * F.least(F.coalesce("_llm_evidence", F.lit(0.0)), F.lit(MOST)))))
    return judged.withColumn("score", score).select(*docs.columns, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
