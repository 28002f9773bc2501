"""A modified Kneser-Ney model of characters as they are, kept in tables and met by joins sharded by n-gram.

No table is gathered in one place. An n-gram is its last character and its ``context``, the code points before it as digits of 21 bits,
the nearest lowest. Tasks add up equal n-grams before the shuffle. Texts to score are dealt to blocks of about ``BLOCK`` bytes by a hash of
the row; each block asks once for each of its n-grams, these meet the model's tables in joins, and the block sums the log
probabilities of its texts. So a task holds what its own block asks for, however large corpus and model are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from weirflow.llm.common import batch, chunks, saved, ship
from weirflow.llm.shingles import mix

ORDER = 4
BITS = 21
#: Bytes of text in one block; n-grams a task adds up before it hands them on.
BLOCK, HELD = 16 << 20, 1 << 20

_EDGE = 0x110000  # stands before a text; no character has it


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, last character and a hash of both for each character; and where each text's characters end."""
    decoded = [t.decode("utf-8", "replace") for t in texts]
    pad = "\0" * (ORDER - 1)
    points = np.frombuffer((pad + pad.join(decoded)).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.array([len(t) for t in decoded])
    ends = np.cumsum(lengths + ORDER - 1)
    real = np.ones(len(points), bool)
    for j in range(ORDER - 1):
        real[ends - lengths - 1 - j] = False
    points[~real] = _EDGE
    context = np.zeros(len(points), np.int64)
    for j in range(1, ORDER):
        context[j:] += points[: len(points) - j] << (BITS * (j - 1))
    context, symbol = context[real], points[real]
    return context, symbol, hashes(context, symbol), np.cumsum(lengths)


def hashes(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(context.astype(np.uint64) + mix(symbol.astype(np.uint64) + np.uint64(1)))


class _Held:
    """Different n-grams and their numbers."""

    def __init__(self):
        self.columns = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, texts: list[bytes]) -> None:
        context, symbol, h, _ = grams(texts)
        h, at, n = np.unique(h, return_index=True, return_counts=True)
        held, total = self.columns[0], self.columns[3]
        where = np.minimum(np.searchsorted(held, h), max(len(held) - 1, 0))
        known = held[where] == h if len(held) else np.zeros(len(h), bool)
        total[where[known]] += n[known]
        if not known.all():
            new = ~known
            columns = [np.concatenate(x) for x in zip(self.columns, (h[new], context[at[new]], symbol[at[new]], n[new]))]
            order = np.argsort(columns[0], kind="stable")
            self.columns = tuple(c[order] for c in columns)


def count_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(context, symbol, c): how often each n-gram occurs in all texts."""
    ship(docs.sparkSession)
    schema = pa.schema([("context", pa.int64()), ("symbol", pa.int64()), ("c", pa.int64())])

    def count(batches):
        held = _Held()
        for part in batches:
            for texts in chunks(part.column(0)):
                held.add(texts)
                if len(held.columns[0]) > HELD:
                    yield batch(schema, *held.columns[1:])
                    held = _Held()
        yield batch(schema, *held.columns[1:])

    return docs.select(text).mapInArrow(count, "context long, symbol long, c long").groupBy("context", "symbol").agg(F.sum("c").alias("c"))


def _suffix(order: int):
    """The context of the last ``order`` characters."""
    return F.col("context").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1)).alias("context")


@dataclass
class Model:
    """Per order, lowest first: (context, symbol, p, c) of what was seen and (context, backoff); p of an unseen character before back-off."""

    levels: list[tuple[DataFrame, DataFrame]]
    unseen: float
    average: float


def train(trusted: DataFrame, text: str = "text") -> Model | None:
    """The model of all texts of ``trusted``; None if they have no character.

    Highest-order counts are occurrences, lower ones the number of different characters seen before. Each order has three
    discounts from its counts of counts, and each context hands what it discounts to the order below. All characters
    that were never seen count as one further character.
    """
    tables = [saved(count_grams(trusted, text), "gram-counts")]
    for order in range(ORDER - 1, 0, -1):
        tables.append(saved(tables[-1].select(_suffix(order), "symbol").groupBy("context", "symbol").agg(F.count("*").alias("c")), "gram-counts"))
    levels: list[tuple[DataFrame, DataFrame]] = []
    unseen = 1.0 / (tables[-1].count() + 1)
    for order, level in enumerate(reversed(tables), 1):
        of = level.agg(*[F.sum((F.col("c") == i).cast("long")) for i in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (float(x or 0) for x in of)
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        # Discounts of n-grams seen once, twice and more often; half of what they can be where the counts say nothing.
        d = [min(i - 0.1, max(0.1, i - (i + 1) * y * b / a)) if a and b else i / 2 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        contexts = saved(level.groupBy("context").agg(F.sum("c").alias("total"), F.sum(taken).alias("taken")), "gram-contexts")
        seen = level.join(contexts, "context")
        if levels:
            lower = levels[-1][0].select(F.col("context").alias("shorter"), "symbol", F.col("p").alias("below"))
            seen = seen.withColumn("shorter", _suffix(order - 1)).join(lower, ["shorter", "symbol"])
        else:
            seen = seen.withColumn("below", F.lit(unseen))
        p = (F.col("c") - taken + F.col("taken") * F.col("below")) / F.col("total")
        seen = saved(seen.select("context", "symbol", p.alias("p"), "c"), "gram-model")
        levels.append((seen, contexts.select("context", (F.col("taken") / F.col("total")).alias("backoff"))))
    average = levels[-1][0].agg(F.sum(F.col("c") * F.log("p")) / F.sum("c")).first()[0]
    return None if average is None else Model(levels, unseen, average)


def probabilities(asked: DataFrame, model: Model) -> DataFrame:
    """(context, symbol, p) of different n-grams (context, symbol): as seen, or by back-off from the order below."""
    below = None
    for order, (seen, contexts) in enumerate(model.levels, 1):
        own = asked.select(_suffix(order), "symbol").distinct()
        if below is None:
            own = own.withColumn("below", F.lit(model.unseen))
        else:
            lower = below.select(F.col("context").alias("shorter"), "symbol", F.col("p").alias("below"))
            own = own.withColumn("shorter", _suffix(order - 1)).join(lower, ["shorter", "symbol"]).drop("shorter")
        own = own.join(contexts, "context", "left").join(seen.select("context", "symbol", "p"), ["context", "symbol"], "left")
        p = F.coalesce("p", F.coalesce("backoff", F.lit(1.0)) * F.col("below"))
        below = saved(own.select("context", "symbol", p.alias("p")), "gram-asked")
    return below


def in_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with ``_llm_block``, the same for a row wherever it stands."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return docs.withColumn("_llm_block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, math.ceil(size / BLOCK)))))


def look_up(blocks: DataFrame, model: Model) -> DataFrame:
    """(block, h, logp): all that the texts of each block ask of the model."""
    ship(blocks.sparkSession)

    def ask(rows: pa.Table) -> pa.Table:
        held, block = _Held(), rows.column("_llm_block")[0].as_py()
        for part in rows.select(["text"]).to_batches():
            for texts in chunks(part.column(0)):
                held.add(texts)
        h, context, symbol, _ = held.columns
        return pa.table({"block": np.full(len(h), block), "h": h.view(np.int64), "context": context, "symbol": symbol})

    asked = blocks.select("_llm_block", "text").groupBy("_llm_block").applyInArrow(ask, "block long, h long, context long, symbol long")
    asked = saved(asked, "gram-blocks")
    known = probabilities(asked.select("context", "symbol").distinct(), model)
    return saved(asked.join(known, ["context", "symbol"]).select("block", "h", F.log("p").alias("logp")), "gram-answers")


def score(blocks: DataFrame, answers: DataFrame, model: Model, least: int, name: str = "perplexity") -> DataFrame:
    """Rows of ``in_blocks`` with the perplexity of their text, which is taken over ``least`` characters at least.

    ``answers`` is ``look_up`` of these blocks, or of more rows. What a short text lacks counts as average text; null counts as empty.
    """
    ship(blocks.sparkSession)
    average = model.average
    names = [c for c in blocks.columns if c != "_llm_block"]

    def judge(rows: pa.Table, answers: pa.Table) -> pa.Table:
        h = answers.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, logp = h[order], answers.column("logp").to_numpy()[order]
        out = []
        for part in rows.select(["text"]).to_batches():
            for texts in chunks(part.column(0)):
                _, _, own, ends = grams(texts)
                at = np.minimum(np.searchsorted(h, own), max(len(h) - 1, 0))
                if len(own) and not (len(h) and (h[at] == own).all()):
                    raise ValueError("a block has an n-gram that it did not ask for")
                total = np.concatenate([[0.0], np.cumsum(logp[at])])
                begins = np.concatenate([[0], ends[:-1]])
                n = ends - begins
                short = np.maximum(least - n, 0)
                out.append(np.exp(-(total[ends] - total[begins] + short * average) / (n + short)))
        return rows.select(names).append_column(name, pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64()))

    schema = StructType([blocks.schema[c] for c in names]).add(name, DoubleType())
    return blocks.groupBy("_llm_block").cogroup(answers.groupBy("block")).applyInArrow(judge, schema)
