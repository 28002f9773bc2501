"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine c or more lie within squared distance 2 - 2c. Rotated and cut into blocks, they lie in some block
within that block's share of it, in proportion to its dimensions. So each block is joined by itself: a grid over the first few of
the block's coordinates brings close ones together, the block's own distance and then the cosine decide. A pair that is close
in several blocks is taken in the first of them, so no pair is met twice and no list of pairs is ever written.

Equal vectors of a label are one row with a weight. A cell too full for one task is cut into parts, and each pair of parts
is joined once.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import saved, ship
from weirflow.llm.components import components

BLOCKS, CELL, PART = 8, 4.0, 4096
#: Rotated coordinates are kept as multiples of 1 / GRID, so that distances in blocks are exact and every task decides alike.
#: SLACK makes up for that rounding: candidates become more, never fewer.
GRID, SLACK = 1 << 20, 1e-5


@lru_cache(4)
def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, always the same."""
    q, r = np.linalg.qr(np.random.default_rng(64).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_cuts(dims: int, blocks: int = BLOCKS) -> list[int]:
    return [dims * i // min(blocks, dims) for i in range(min(blocks, dims) + 1)]


def _units(vectors: list) -> np.ndarray:
    """Rows scaled to length 1, first by their largest entry so that squares neither overflow nor vanish."""
    x = np.array(list(vectors), np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _rooms(dims: int, cosine: float) -> np.ndarray:
    """The squared distance allowed in each block."""
    return (2 - 2 * cosine) * np.diff(block_cuts(dims)) / dims + SLACK


def turned(x: np.ndarray) -> np.ndarray:
    """Unit rows in rotated coordinates, in whole multiples of 1 / GRID."""
    return np.rint(x @ rotation(x.shape[1]) * GRID).astype(np.int32)


def cells(x: np.ndarray, cosine: float, depth: int) -> list[list[str]]:
    """For each row of ``turned`` the cells where it must stand: its own of each block, and as a visitor those its range reaches.

    A cell is ``block:coordinates`` in a grid over ``depth`` coordinates of the block; a visit has a leading ``~``. Visits
    go to larger cells only, as one of each pair of cells is enough.
    """
    n, dims = x.shape
    cuts, out = block_cuts(dims), [[] for _ in range(n)]
    for b, room in enumerate(_rooms(dims, cosine)):
        radius = math.sqrt(room)
        part = x[:, cuts[b] : cuts[b + 1]][:, :depth] / GRID
        own, low, high = (np.floor((part + d) / (CELL * radius)).astype(int).tolist() for d in (0.0, -radius, radius))
        for i in range(n):
            reach = [()]
            for least, most in zip(low[i], high[i]):
                reach = [(*r, c) for r in reach for c in range(least, most + 1)]
            mine = tuple(own[i])
            out[i].append(f"{b}:{mine}")
            out[i] += [f"~{b}:{r}" for r in reach if r > mine]
    return out


def _distances(u: np.ndarray, v: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows; exact, as all terms are multiples of 1 / GRID squared."""
    d = (u[i] - v[j]) / GRID
    return (d * d).sum(axis=1)


def linked_pairs(x, u, y, v, block: int, cosine: float):
    """Positions (i, j) of unit rows x, y with that cosine or more whose first close block is ``block``; u, v are ``turned``."""
    cuts, rooms = block_cuts(x.shape[1]), _rooms(x.shape[1], cosine)
    parts = [(u[:, a:b].astype(np.float64), v[:, a:b].astype(np.float64)) for a, b in zip(cuts, cuts[1:])]
    a, b = (p / GRID for p in parts[block])
    right = (b * b).sum(axis=1)
    step = max(1, (1 << 21) // max(1, len(y)))
    for at in range(0, len(x), step):
        p = a[at : at + step]
        i, j = np.nonzero((p * p).sum(axis=1)[:, None] + right - 2 * p @ b.T <= rooms[block] + SLACK)
        for some in range(0, len(i), 1 << 18):
            left, other = i[some : some + (1 << 18)] + at, j[some : some + (1 << 18)]
            keep = np.einsum("ij,ij->i", x[left], y[other]) >= cosine
            left, other = left[keep], other[keep]
            for k in range(block + 1):
                close = _distances(*parts[k], left, other) <= rooms[k]
                keep = close if k == block else ~close
                left, other = left[keep], other[keep]
            yield left, other


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Link the vectors (vec_id, embedding, label) of one label whose cosine is ``cosine`` or more.

    Returns per row vec_id, n_links (other rows linked directly), component_id (the smallest vec_id reachable by links) and kept
    (vec_id = component_id). A vector that is null, empty, zero or holds a null or a value that is not finite, one without a label and one without a
    vec_id have no links and are kept. Vectors of different lengths are not compared. Repeated rows link with each other; rows that
    share a vec_id share their component. Other columns are not read; an empty table gives no rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", "label", "embedding").withColumn("vec_id", F.col("vec_id").cast("long"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~odd & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    # 0.0 and -0.0 are one value in a group, and alike for the cosine.
    known = rows.where("valid").groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    known = saved(known, "vector-classes")
    most = known.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    depth = min(8, max(1, math.ceil(math.log(max(1, most / 2000), 3))))

    def places(batches):
        for pdf in batches:
            dims = pdf["embedding"].map(len)
            for d in dims.unique():
                some = pdf[dims == d]
                x = turned(_units(some["embedding"]))
                some = some.assign(dims=int(d), turned=[r.tobytes() for r in x], cell=cells(x, cosine, depth))
                for at in range(0, len(some), 500):
                    yield some.iloc[at : at + 500].explode("cell")

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in known.schema)
    spread = known.mapInPandas(places, f"{shape}, dims int, turned binary, cell string")
    spread = spread.withColumns({"visit": F.startswith("cell", F.lit("~")), "cell": F.ltrim("cell", F.lit("~"))})
    cell = ["label", "dims", "cell"]
    parts = spread.groupBy(*cell).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"), F.count("*").alias("n"), F.sum(F.col("visit").cast("int")).alias("visits"))
    parts = parts.where("n > 1 and visits < n").drop("n", "visits")
    spread = spread.join(parts, cell).withColumn("part", F.pmod(F.xxhash64("first"), F.col("parts")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}).drop("parts", "other")

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["cell"].iloc[0].partition(":")[0])
        first, weight, part, visit = (pdf[c].to_numpy() for c in ("first", "weight", "part", "visit"))
        x = _units(pdf["embedding"])
        u = np.frombuffer(b"".join(pdf["turned"]), np.int32).reshape(len(x), -1)
        total, parent = np.zeros(len(x), np.int64), list(range(len(x)))

        def root(k):
            while parent[k] != k:
                parent[k] = k = parent[parent[k]]
            return k

        home = np.flatnonzero(~visit)
        for i, j in linked_pairs(x[home], u[home], x, u, block, cosine):
            i = home[i]
            # Two at home are met both ways, a visitor once; across two parts, only pairs between them.
            once = (visit[j] | (i < j)) & ((part[i] != part[j]) | (pdf["i"].iloc[0] == pdf["j"].iloc[0]))
            i, j = i[once], j[once]
            np.add.at(total, i, weight[j])
            np.add.at(total, j, weight[i])
            for p, q in zip(i.tolist(), j.tolist()):
                p, q = root(p), root(q)
                parent[max(p, q)] = min(p, q)
        has = np.flatnonzero(total)
        return pd.DataFrame({"first": first[has], "root": [first[root(k)] for k in has.tolist()], "links": total[has]})

    found = saved(spread.repartition(*cell, "i", "j").groupBy(*cell, "i", "j").applyInPandas(join, "first long, root long, links long"), "vector-links")
    links = found.groupBy("first").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("first").alias("a"), F.col("root").alias("b")))
    roots = roots.select(F.col("vertex").alias("first"), F.col("root").alias("component_id"))
    classes = known.join(links, "first", "left").join(roots, "first", "left").select(
        "label", "embedding", F.coalesce("component_id", "first").alias("component_id"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    judged = rows.where("valid").join(classes, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return judged.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
