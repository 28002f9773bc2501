"""A Merkle manifest of a dataset, kept as a persistent tree: a changed leaf makes a version that copies its ancestors only.

Per source the documents' leaves stand by doc_id, every three nodes in a row become one node of the level above, and so on to one
subroot; the subroots, by source, become one root in the same way.

1. ``numbered`` gives each leaf its place, so a source of any size is spread over tasks.
2. ``climb``: an aligned block of ``3 ** HEIGHT`` nodes is one group, hashed up ``HEIGHT`` levels. Its top is a node of the next
   round, until each source has one. The subroots climb in the same way.
3. ``descend``, round by round from the root: each block gets the siblings on the way from its top to the root and adds those within
   itself. Only these short lists move, one per block; no node of another block does.
4. In the last of these steps each changed leaf opens its version: the block's task copies the ancestors within the block, and goes
   on along the list for the levels above it. All other nodes are those of the first tree and are not written again.

So a leaf is shuffled three times as a row of about 200 bytes, whatever its text, and a version costs one digest per level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import saved, ship
from weirflow.llm.places import numbered

#: Nodes that become one, and levels of one block: 243 nodes.
WAYS, HEIGHT = 3, 5
SPAN = WAYS**HEIGHT

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of subroots. Those of sources are called ``-`` for null, else ``=`` and the source, which keeps null first.
TOP = "^"


def _part(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The digest of a row of documents, with ``text`` for its own."""
    values = [F.col(c) for c in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*map(_part, values)), 256)


def levels(digests: list[str], total: int) -> list[list[str]]:
    """The digests of a block and the levels made of them; ``total`` is the number of nodes its tree has on the first."""
    out = [digests]
    while len(out) <= HEIGHT and total > 1:
        below, total = out[-1], -(-total // WAYS)
        out.append([sha256("".join(below[i : i + WAYS]).encode()).hexdigest() for i in range(0, len(below), WAYS)])
    return out


def _siblings(made: list[list[str]], at: int) -> Iterator[tuple[str, str]]:
    """What stands left and right of the node at each level, from the one ``at`` that place up to the block's top."""
    for level in made[:-1]:
        first = at - at % WAYS
        yield "".join(level[first:at]), "".join(level[at + 1 : first + WAYS])
        at //= WAYS


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / SPAN))


_NODE = "tree string, place long, total long, digest string"


def climb(nodes: DataFrame) -> DataFrame:
    """The tops of all blocks of ``nodes`` (tree, place, total, digest), as nodes of the next round."""

    def tops(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        total = int(rows["total"].iloc[0])
        made = levels(rows["digest"].tolist(), total)
        return pd.DataFrame({"tree": rows["tree"].iloc[:1], "place": rows["block"].iloc[:1], "total": -(-total // SPAN), "digest": made[-1]})

    blocks = _blocks(nodes.select("tree", "place", "total", "digest"))
    return blocks.groupBy("tree", "block").applyInPandas(tops, _NODE)


def _to_the_top(nodes: DataFrame) -> list[DataFrame]:
    """All rounds, from ``nodes`` to a table of one node per tree; two at least."""
    rounds = [nodes]
    while len(rounds) < 2 or rounds[-1].where("total > 1").limit(1).count():
        rounds.append(saved(climb(rounds[-1]), "merkle-nodes"))
    return rounds


@dataclass
class Manifest:
    """The nodes at the foot of each round of blocks, lowest first: those of the sources, and those above the subroots."""

    sources: list[DataFrame]
    top: list[DataFrame]


def build(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """The tree of ``docs`` (doc_id, source, lang, n_chars, text; other columns are not read).

    ``changed`` is the text of a row now, where a version is asked for: the row's leaf of it is kept beside the first where both
    differ. Leaves of one doc_id in one source stand by their digest, null doc_ids first; a repeated row is a leaf of its own.
    """
    ship(docs.sparkSession)
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    now = F.lit(None).cast("string") if changed is None else F.nullif(leaf(changed), leaf())
    leaves = docs.select("doc_id", tree.alias("tree"), leaf().alias("digest"), now.alias("now"))
    leaves = saved(numbered(leaves, "tree", ["doc_id", "digest"]), "merkle-leaves")
    sources = _to_the_top(leaves)
    subroots = sources[-1].select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest")
    top = _to_the_top(saved(numbered(subroots, "tree", ["of"]), "merkle-subroots"))
    return Manifest(sources, top)


_WAY = "way array<struct<left:string,right:string>>"
_ROOTS = "subroot string, root string"


def _fold(digest: str, way: list[tuple[str, str]]) -> list[str]:
    """The nodes from a leaf to the root, given their siblings."""
    out = [digest]
    for left, right in way:
        out.append(sha256((left + out[-1] + right).encode()).hexdigest())
    return out


def _with_ways(nodes: DataFrame, above: DataFrame, finish, fields: str) -> DataFrame:
    """Each block of ``nodes`` beside its top's row of ``above``: ``finish(rows, ways, over)`` makes rows of ``fields``."""

    def extend(rows: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        rows, over = rows.sort_values("place", ignore_index=True), over.iloc[0]
        made = levels(rows["digest"].tolist(), int(rows["total"].iloc[0]))
        up = [(w["left"], w["right"]) for w in over["way"]]
        return finish(rows, [[*_siblings(made, i), *up] for i in range(len(rows))], over)

    over = above.select("tree", F.col("place").alias("block"), "way", "subroot", "root")
    return _blocks(nodes).groupBy("tree", "block").cogroup(over.groupBy("tree", "block")).applyInPandas(extend, fields)


def descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` of a round with ``way``, their siblings level by level up to the root, and with ``subroot`` and ``root``.

    ``above`` has these of the tops of the blocks. Further columns of ``nodes`` are kept.
    """
    columns = nodes.columns

    def finish(rows, ways, over):
        pairs = [[{"left": a, "right": b} for a, b in way] for way in ways]
        return rows[columns].assign(way=pairs, subroot=over["subroot"], root=over["root"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    return _with_ways(nodes, above, finish, f"{kept}, {_WAY}, {_ROOTS}")


def _ways_of_subroots(manifest: Manifest) -> DataFrame:
    """The topmost nodes of the sources with their ways, as ``above`` of :func:`descend`."""
    one, nothing = manifest.top[-1], F.lit(None).cast("string")
    way = F.array().cast("array<struct<left:string,right:string>>").alias("way")
    above = one.select("tree", "place", way, nothing.alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(manifest.top[:-1]):
        above = saved(descend(nodes, above), "merkle-ways")
    return above.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "way", F.col("digest").alias("subroot"), "root")


_LEAF = "doc_id long, tree string, place long, leaf string, now string"


def proven(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof, and the version that its change opens.

    doc_id, tree, place, leaf, now (null if nothing changed), subroot, root, proof_sha256 (of the siblings up to the root), ``folded_root``
    (the root of the leaf's version, else the first root made again from its leaf) and ``copies``: the nodes that the version has for itself, from the leaf
    to the root; null without a change. With a source's ``D`` levels, ``copies[i]`` for i up to D stands at ``place`` divided by 3 ** i.
    """
    ship(manifest.sources[0].sparkSession)
    above = _ways_of_subroots(manifest)
    for nodes in reversed(manifest.sources[1:-1]):
        above = saved(descend(nodes, above), "merkle-ways")

    def finish(rows, ways, over):
        now = [x if isinstance(x, str) else None for x in rows["now"]]
        paths = [_fold(x or first, way) for x, first, way in zip(now, rows["digest"], ways)]
        return rows[["doc_id", "tree", "place"]].assign(
            leaf=rows["digest"],
            now=now,
            subroot=over["subroot"],
            root=over["root"],
            proof_sha256=[sha256("".join(a + b for a, b in way).encode()).hexdigest() for way in ways],
            folded_root=[path[-1] for path in paths],
            copies=[path if x else None for x, path in zip(now, paths)],
        )

    fields = f"{_LEAF}, {_ROOTS}, proof_sha256 string, folded_root string, copies array<string>"
    return _with_ways(manifest.sources[0], above, finish, fields)


def tree_nodes(manifest: Manifest) -> DataFrame:
    """(tree, level, place, digest) of every node of the first tree, leaves at level 0; ``^`` is the tree of subroots."""

    def listed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        made = levels(rows["digest"].tolist(), int(rows["total"].iloc[0]))
        first, out = int(rows["place"].iloc[0]), []
        for up, level in enumerate(made):
            # The top of a block is listed by the next round, but for the last.
            if up < HEIGHT:
                out += [(rows["tree"].iloc[0], up, first // WAYS**up + i, digest) for i, digest in enumerate(level)]
        return pd.DataFrame(out, columns=["tree", "level", "place", "digest"])

    def of(rounds: list[DataFrame]) -> DataFrame:
        parts = []
        for i, nodes in enumerate(rounds[:-1]):
            # A tree that has come to one node is listed where it first did.
            nodes = nodes if i == 0 else nodes.where("total > 1")
            made = _blocks(nodes.select("tree", "place", "total", "digest")).groupBy("tree", "block")
            made = made.applyInPandas(listed, "tree string, level int, place long, digest string")
            parts.append(made.withColumn("level", F.col("level") + i * HEIGHT))
            tops = rounds[i + 1].where("total = 1").select("tree", "place", "digest")
            full = nodes.where(f"total > {WAYS ** (HEIGHT - 1)} and total <= {SPAN}").select("tree").distinct()
            parts.append(tops.join(full, "tree").select("tree", F.lit((i + 1) * HEIGHT).alias("level"), "place", "digest"))
        return reduce(DataFrame.unionByName, parts)

    return of(manifest.sources).unionByName(of(manifest.top))


def without_line_feeds() -> Column:
    """The text without its line feeds where 2 divides the CRC-32 of the decimal doc_id, else the text itself."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def verify(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """Each row of ``docs`` against the manifest of all of them, after ``changed`` has been done to its text.

    doc_id, leaf, subroot, root, proof_sha256, folded_root and verified: whether the changed row still leads to the root. By default
    :func:`without_line_feeds`. Nulls in any column are hashed as such, a null doc_id and a null text are never changed, empty and long texts are
    hashed whole, repeated rows are leaves of their own beside each other, and an empty table gives no rows.
    """
    rows = proven(build(docs, without_line_feeds() if changed is None else changed))
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    return rows.select(*columns, (F.col("folded_root") == F.col("root")).alias("verified"))
