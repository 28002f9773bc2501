"""Noisy-channel deobfuscation: what word did the writer of ``1d10t``, ``s t u p i d`` or ``loooser`` mean?

1. ``units``: a text is cut at white space into words without the punctuation around them; three or more single characters in a row,
   as in ``i d i o t``, stay together as one unit. Arrow does this for a batch at once.
2. ``vocabulary`` counts the units of all texts. Those of letters alone train a model of characters (five characters,
   interpolated after Witten and Bell); its tables grow with the corpus, stay on the cluster, and are met by joins.
3. A unit that holds something between its letters, or a letter three times in a row, is a lattice: each of its cells may have been
   meant in several ways, at a cost each. ``restore`` asks the model once for each n-gram of all lattices of a block of units,
   and finds the best path of each lattice by the Viterbi algorithm.

Each different unit of a corpus is decoded once, however often it occurs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import batch, saved, ship
from weirflow.llm.shingles import mix

# What a sign may stand for, letters that look alike, what is cut off around a word, and signs without a width.
MEANT = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
ALIKE = dict(zip("аеорсхуікмтвн", "aeopcxyikmtbh"))
AROUND = ".,;:?!%&#*\"'`´()[]{}<>=~^/\\|_-–—…«»„“”‘’¡¿•·"
NO_WIDTH = "­​‌‍⁠﻿"

#: Log probabilities of the channel: a sign for what it means, a letter repeated. Whether a gap ends a word is left to the model.
SIGN, REPEATED = math.log(0.02), math.log(0.02)
#: Characters of units decoded in one block; different units a task counts before it hands them on.
BLOCK, HELD = 1 << 20, 1 << 20
#: Cells after which a path is final, so that a unit of any length is decoded in little memory.
FINAL = 512

#: Characters of an n-gram, and bits of each in a context, nearest lowest. Characters beyond those bits share codes.
ORDER, BITS = 5, 15
_EDGE = (1 << BITS) - 1
_MASK = (1 << BITS * (ORDER - 1)) - 1
#: The context of a word's first character.
_START = _MASK


def _codes(points: np.ndarray) -> np.ndarray:
    return np.where(points < _EDGE, points, (1 << 14) + points % ((1 << 14) - 1))


@lru_cache(1 << 16)
def _code(symbol: str) -> int:
    return int(_codes(np.array([ord(symbol)]))[0])


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context and code of each character of the words and of the space that ends each; and the number of these per word."""
    edges = "\0" * (ORDER - 1)
    points = np.frombuffer("".join(f"{edges}{w} " for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.array([len(w) + 1 for w in words])
    codes, real = _codes(points), np.ones(len(points), bool)
    begins = np.cumsum(lengths + ORDER - 1) - lengths
    for j in range(1, ORDER):
        real[begins - j] = False
    codes[~real] = _EDGE
    context = np.zeros(len(points), np.int64)
    for j in range(1, ORDER):
        context[j:] |= codes[: len(points) - j] << (BITS * (j - 1))
    return context[real], codes[real], lengths


def units(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The units of a batch of texts, in lower case: the row each stands in, and the unit. A null text has none."""
    lower = pc.utf8_lower(pc.replace_substring_regex(texts.cast(pa.large_string()), f"[{NO_WIDTH}]", ""))
    lists = pc.utf8_split_whitespace(lower)
    words, row = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    cores = pc.utf8_trim(words, AROUND)
    # Runs of single characters in one text; a sign among them counts, such as the 1 of "1 d i o t".
    single = (pc.utf8_length(words).to_numpy() == 1).astype(np.int8)
    run = np.concatenate([[0], np.cumsum((np.diff(row) != 0) | (np.diff(single) != 0))]) if len(row) else row
    begins = np.flatnonzero(np.diff(run, prepend=-1))
    lengths = np.diff(np.append(begins, len(run)))
    spaced = np.flatnonzero((lengths >= 3) & (single[begins] == 1))
    alone = np.repeat((lengths < 3) | (single[begins] == 0), lengths)
    joined = pa.array([" ".join(words.slice(begins[i], lengths[i]).to_pylist()).strip(AROUND + " ") for i in spaced.tolist()], cores.type)
    cores, row = pa.concat_arrays([cores.filter(pa.array(alone)), joined]), np.concatenate([row[alone], row[begins[spaced]]])
    some = pc.greater(pc.binary_length(cores), 0)
    return row[some.to_numpy(zero_copy_only=False)], cores.filter(some)


def batches_of(parts: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The same rows, about ``limit`` bytes of text at a time."""
    for part in parts:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy()) // limit
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), part.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield part.slice(a, b - a)


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(unit, n): how often each unit stands in all texts. Tasks add up their own before the shuffle."""
    ship(docs.sparkSession)
    schema = pa.schema([("unit", pa.string()), ("n", pa.int64())])

    def count(parts):
        held = []
        for part in batches_of(parts):
            found = units(part.column("text"))[1].value_counts()
            held.append(pa.table([found.field(0).cast(pa.string()), found.field(1)], schema=schema))
            if sum(map(len, held)) > HELD:
                held = [pa.concat_tables(held).group_by("unit").aggregate([("n", "sum")]).rename_columns(["unit", "n"])]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches(65_536)
        if held:
            yield from pa.concat_tables(held).group_by("unit").aggregate([("n", "sum")]).rename_columns(["unit", "n"]).to_batches(65_536)

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "unit string, n long")
    return counted.groupBy("unit").agg(F.sum("n").alias("n"))


def is_plain(unit: Column) -> Column:
    """Letters alone, none of them three times in a row, and none that only looks like a Latin letter among Latin ones."""
    mixed = unit.rlike("[" + "".join(ALIKE) + "]") & unit.rlike("[a-z]")
    return unit.rlike(r"^[\p{L}\p{M}]+$") & ~unit.rlike(r"(\p{L})\1\1") & ~mixed


def is_doubtful(unit: Column) -> Column:
    """A unit that may stand for another one: it has a letter, and is not plain."""
    return unit.rlike(r"\p{L}") & ~is_plain(unit)


def _last(order: int) -> Column:
    """The context of an n-gram of ``order`` characters."""
    return F.col("context").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1)).alias("context")


@dataclass
class Model:
    """Per order, lowest first: (context, symbol, p) of what was seen and (context, backoff); p of an unseen character before back-off."""

    levels: list[tuple[DataFrame, DataFrame]]
    unseen: float


def train(words: DataFrame) -> Model:
    """The model of the characters of ``words`` (unit, n), each as often as it occurs, a space as its end."""
    ship(words.sparkSession)
    schema = pa.schema([("context", pa.int64()), ("symbol", pa.int64()), ("c", pa.int64())])

    def count(parts):
        for part in parts:
            context, symbol, lengths = grams(part.column("unit").to_pylist())
            times = np.repeat(part.column("n").to_numpy(), lengths)
            h = mix(context.astype(np.uint64) + mix(symbol.astype(np.uint64) + np.uint64(1)))
            _, at, of = np.unique(h, return_index=True, return_inverse=True)
            yield batch(schema, context[at], symbol[at], np.bincount(of, times).astype(np.int64))

    counts = words.select("unit", "n").mapInArrow(count, "context long, symbol long, c long")
    tables = [saved(counts.groupBy("context", "symbol").agg(F.sum("c").alias("c")), "unit-grams")]
    for order in range(ORDER - 1, 0, -1):
        tables.append(saved(tables[-1].groupBy(_last(order), "symbol").agg(F.sum("c").alias("c")), "unit-grams"))
    unseen, levels = 1.0 / (tables[-1].count() + 1), []
    for order, level in enumerate(reversed(tables), 1):
        contexts = level.groupBy("context").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        seen = level.join(contexts, "context")
        if levels:
            below = levels[-1][0].select(F.col("context").alias("shorter"), "symbol", F.col("p").alias("below"))
            seen = seen.withColumn("shorter", _last(order - 1)).join(below, ["shorter", "symbol"])
        else:
            seen = seen.withColumn("below", F.lit(unseen))
        p = (F.col("c") + F.col("kinds") * F.col("below")) / (F.col("total") + F.col("kinds"))
        backoff = F.col("kinds") / (F.col("total") + F.col("kinds"))
        levels.append((saved(seen.select("context", "symbol", p.alias("p")), "unit-model"), saved(contexts.select("context", backoff.alias("backoff")), "unit-contexts")))
    return Model(levels, unseen)


def probabilities(steps: DataFrame, model: Model) -> DataFrame:
    """(context, symbol, p) of different n-grams (context, symbol): as seen, or by back-off from the order below."""
    below = None
    for order, (seen, contexts) in enumerate(model.levels, 1):
        own = steps.select(_last(order), "symbol").distinct()
        if below is None:
            own = own.withColumn("below", F.lit(model.unseen))
        else:
            lower = below.select(F.col("context").alias("shorter"), "symbol", F.col("p").alias("below"))
            own = own.withColumn("shorter", _last(order - 1)).join(lower, ["shorter", "symbol"]).drop("shorter")
        own = own.join(contexts, "context", "left").join(seen, ["context", "symbol"], "left")
        p = F.coalesce("p", F.coalesce("backoff", F.lit(1.0)) * F.col("below"))
        below = saved(own.select("context", "symbol", p.alias("p")), "unit-steps")
    return below


def lattice(unit: str) -> Iterator[list[tuple[str, float]]]:
    """The cells of a unit: what each may have been meant for, with its log probability. A space ends a word, as does the last cell."""
    for c, run in groupby(unit):
        n = len(list(run))
        if c.isalpha():
            if n >= 3:
                yield [(c, REPEATED), (2 * c, REPEATED), (n * c, 0.0)]
                continue
            ways = [(c, 0.0), (ALIKE[c], SIGN)] if c in ALIKE else [(c, 0.0)]
        elif c in MEANT:
            ways = [(x, SIGN) for x in MEANT[c]] + ([(c, 0.0)] if c.isdigit() else [("", SIGN), (" ", SIGN)])
        elif c.isalnum():
            ways = [(c, 0.0)]
        else:
            n, ways = 1, [("", 0.0), (" ", 0.0)]
        for _ in range(n):
            yield ways
    yield [(" ", 0.0)]


def _after(context: int, symbol: str) -> int:
    return _START if symbol == " " else ((context << BITS) & _MASK) | _code(symbol)


def asked(unit: str) -> Iterator[tuple[int, int]]:
    """(context, symbol) of every step in the unit's lattice, some of them several times."""
    contexts = {_START}
    for cell in lattice(unit):
        after = set()
        for context in contexts:
            for way, _ in cell:
                at = context
                for symbol in way:
                    yield at, _code(symbol)
                    at = _after(at, symbol)
                after.add(at)
        contexts = after


def decode(unit: str, logp: dict[tuple[int, int], float]) -> str:
    """The best path through the unit's lattice, words set apart by one space."""
    done: list[str] = []
    # Per context: log probability, and the path as a linked list from its end.
    paths = {_START: (0.0, None)}
    for i, cell in enumerate(lattice(unit), 1):
        after: dict[int, tuple[float, tuple | None]] = {}
        for context, (so_far, path) in paths.items():
            for way, cost in cell:
                at, total = context, so_far + cost
                for symbol in way:
                    # A second space ends no word.
                    if symbol != " " or at != _START:
                        total += logp[at, _code(symbol)]
                    at = _after(at, symbol)
                if at not in after or total > after[at][0]:
                    after[at] = (total, (path, way))
        paths = after
        if i % FINAL == 0:
            context = max(paths, key=lambda c: paths[c][0])
            done.append(_written(paths[context][1]))
            paths = {context: (0.0, None)}
    done.append(_written(max(paths.values(), key=lambda p: p[0])[1]))
    return " ".join("".join(done).split())


def _written(path: tuple | None) -> str:
    out = []
    while path is not None:
        path, way = path
        out.append(way)
    return "".join(reversed(out))


def restore(doubtful: DataFrame, model: Model) -> DataFrame:
    """(unit, meant) of different units: their best reading under the model, which may be of several words."""
    ship(doubtful.sparkSession)
    size = doubtful.agg(F.sum(F.length("unit"))).first()[0] or 0
    block = F.pmod(F.xxhash64("unit"), F.lit(max(1, math.ceil(size / BLOCK)))).cast("long")
    blocks = saved(doubtful.select(block.alias("block"), "unit"), "unit-blocks")

    def ask(rows: pa.Table) -> pa.Table:
        wanted = set()
        for unit in rows.column("unit").to_pylist():
            wanted.update(asked(unit))
        context, symbol = zip(*wanted)
        return pa.table({"block": np.full(len(wanted), rows.column("block")[0].as_py()), "context": context, "symbol": symbol})

    steps = saved(blocks.groupBy("block").applyInArrow(ask, "block long, context long, symbol long"), "unit-asked")
    known = probabilities(steps.select("context", "symbol").distinct(), model)
    answers = steps.join(known, ["context", "symbol"]).select("block", "context", "symbol", F.log("p").alias("logp"))

    def best(rows: pa.Table, answers: pa.Table) -> pa.Table:
        keys = zip(answers.column("context").to_pylist(), answers.column("symbol").to_pylist())
        logp = dict(zip(keys, answers.column("logp").to_pylist()))
        found = rows.column("unit").to_pylist()
        return pa.table({"unit": found, "meant": [decode(unit, logp) for unit in found]})

    both = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(best, "unit string, meant string")
