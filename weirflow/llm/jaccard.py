"""N-gram Jaccard join: T-occurrence search over inverted lists, with DivideSkip.

1. ``shingle_table``: each text's set of shingle hashes, known by a hash of the whole set, so equal sets are one.
2. ``_postings`` and ``_frequent``: groups of sets deal their shingles by ranges of the hash, packed by numpy, and each
   range finds in how many sets a shingle lies. A shingle of one set only can be in no overlap and ends here. One that several sets of a
   group have is sent once, with their number, so a shingle of very many documents is a row per group and not per document.
3. ``_live``: per set, its shared shingles, rarest first. A set of n shingles needs ``T = ceil(t * n)`` in common with
   a partner, so two linked sets share one of their ``n - T + 1`` rarest. Most sets have that many of their own
   and are done. Sets that share such a shingle get the same bucket, by connected components.
4. ``_search``: in a bucket, inverted lists; for each set the short lists are merged in order, the longest are only
   probed by binary search for what the short ones left, and overlaps that reach the threshold are links. A bucket too
   large for one task is cut into blocks, and each pair of blocks is searched once.

Exact up to a collision of 64-bit hashes. Copies of one set travel as one row with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import batch, chunks, runs, saved, ship
from weirflow.llm.components import components
from weirflow.llm.shingles import shingle_sets

#: Shingles in one range of hashes; shared shingles and sets of one block in the search.
RANGE_SIZE, BLOCK_SIZE, BLOCK_SETS = 1_500_000, 2_000_000, 1024
#: What a binary search costs against one step of a merge: DivideSkip probes T / (PROBE * log2(longest) + 1) lists.
PROBE = 1.0


def _set_id(keys: np.ndarray) -> int:
    return int.from_bytes(blake2b(keys.tobytes(), digest_size=8).digest(), "little", signed=True)


def shingle_table(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_id) per row; set_id is null where there is no word."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64())])

    def sets(batches):
        for part in batches:
            n, ids = [], []
            for texts in chunks(part.column(1)):
                for keys in shingle_sets(texts, words):
                    n.append(len(keys))
                    ids.append(_set_id(keys) if len(keys) else None)
            yield batch(schema, part.column(0), n, ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sets, "doc_id long, n_shingles long, set_id long")


def _spread(keys: np.ndarray, n: int) -> np.ndarray:
    """Which of n equal ranges of 64-bit hashes each value lies in."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


# What blobs hold, column after column. group: its sets, their ids and sizes. postings: shingles and the place of their set in its group;
# shared: the same with the number of sets that have it. counted: shingles of several sets of the group, and their number there; totals: the
# same after the number in all groups. own: the places of those sets, shingle by shingle; they stay with the group.
# A group's places fit 16 bits, so a shingle is 10 bytes however many ranges there are.
_KINDS = {
    "group": ("i8", "i4"), "own": ("u2",), "postings": ("u8", "u2"), "counted": ("u8", "u4"), "shared": ("u8", "u4", "u2"), "totals": ("u8", "u4", "u4"),
}
GROUP_SETS = 60_000


def _pack(kinds: tuple[str, ...], *columns: np.ndarray) -> bytes:
    return b"".join(c.astype(f"<{k}").tobytes() for c, k in zip(columns, kinds))


def _unpack(kinds: tuple[str, ...], blobs) -> list[np.ndarray]:
    """The columns of all blobs, one after the other."""
    parts = []
    for blob in blobs:
        n, at, row = len(blob) // sum(int(k[1]) for k in kinds), 0, []
        for k in kinds:
            row.append(np.frombuffer(blob, f"<{k}", n, at))
            at += row[-1].nbytes
        parts.append(row)
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, f"<{k}") for k in kinds]


def _postings(docs: DataFrame, words: int, ranges: int) -> DataFrame:
    """(part, grp, kind, blob): the shingles of groups of sets, dealt by ranges; and what a range only passes on to the group."""
    schema = pa.schema([("part", pa.int32()), ("grp", pa.int64()), ("kind", pa.string()), ("blob", pa.binary())])

    def dealt(grp: int, held: dict[int, np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(k) for k in held.values()])
        keys, owner = np.concatenate(list(held.values())), np.repeat(np.arange(len(held)), sizes)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        begins = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]))
        n = np.diff(np.append(begins, len(keys)))
        once = np.zeros(len(keys), bool)
        once[order] = np.repeat(n == 1, n)
        rows = [(grp % ranges, grp, "group", _pack(_KINDS["group"], np.array(list(held)), sizes))]
        if not once.all():
            rows.append((grp % ranges, grp, "own", _pack(_KINDS["own"], owner[order][~once[order]])))
        # Within a range shingles stay set by set: that keeps the places in runs, which shuffles compress.
        for kind, columns in (("postings", (keys[once], owner[once])), ("counted", (ordered[begins[n > 1]], n[n > 1]))):
            goes_to = _spread(columns[0], ranges)
            by_range = np.argsort(goes_to, kind="stable")
            cuts = np.searchsorted(goes_to[by_range], np.arange(ranges + 1)).tolist()
            for to, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if a < b:
                    rows.append((to, grp, kind, _pack(_KINDS[kind], *(c[by_range[a:b]] for c in columns))))
        return batch(schema, *zip(*rows))

    def deal(batches):
        first, n = TaskContext.get().partitionId() << 32, 0
        for part in batches:
            for group in chunks(part.column(1), 4 << 20):
                held: dict[int, np.ndarray] = {}
                for run in runs(map(len, group)):
                    for keys in shingle_sets(group[run], words):
                        if len(keys):
                            held.setdefault(_set_id(keys), keys)
                        if len(held) == GROUP_SETS:
                            yield dealt(first + n, held)
                            held, n = {}, n + 1
                if held:
                    yield dealt(first + n, held)
                    n += 1

    return docs.select(F.lit(0), "text").mapInArrow(deal, "part int, grp long, kind string, blob binary")


def _frequent(postings: DataFrame) -> DataFrame:
    """(grp, kind, blob): the shingles that lie in two sets or more, with that number, back in their groups.

    A set that stands in several groups counts once for each; that makes its shingles seem more frequent, in all places alike.
    """

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        posted, counted = pdf[pdf["kind"] == "postings"], pdf[pdf["kind"] == "counted"]
        keys, owner = _unpack(_KINDS["postings"], posted["blob"])
        several, n = _unpack(_KINDS["counted"], counted["blob"])
        every, where = np.unique(np.concatenate([keys, several]), return_inverse=True)
        df = np.bincount(where, np.concatenate([np.ones(len(keys)), n]), len(every)).astype(np.int64)[where]
        out = []
        cuts = np.cumsum([0, *(len(b) // 10 for b in posted["blob"])]).tolist()
        for grp, a, b in zip(posted["grp"], cuts[:-1], cuts[1:]):
            at = a + np.flatnonzero(df[a:b] > 1)
            if len(at):
                out.append((grp, "shared", _pack(_KINDS["shared"], keys[at], df[at], owner[at])))
        cuts = np.cumsum([0, *(len(b) // 12 for b in counted["blob"])]).tolist()
        for grp, a, b in zip(counted["grp"], cuts[:-1], cuts[1:]):
            out.append((grp, "totals", _pack(_KINDS["totals"], several[a:b], df[len(keys) + a : len(keys) + b], n[a:b])))
        passed = pdf.loc[pdf["kind"].isin(["group", "own"]), ["grp", "kind", "blob"]]
        return pd.concat([passed, pd.DataFrame(out, columns=["grp", "kind", "blob"])])

    return postings.groupBy("part").applyInPandas(count, "grp long, kind string, blob binary")


def _needed(n, num: int, den: int):
    """Shingles that a set of n must share with any partner."""
    return -(-num * n // den)


def _live(frequent: DataFrame, num: int, den: int) -> DataFrame:
    """Sets that may have a partner: size, shared shingles rarest first, and how many of them to look up."""
    fields = "set_id long, n int, keys array<long>, prefix int"

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        got = {kind: _unpack(of, pdf.loc[pdf["kind"] == kind, "blob"]) for kind, of in _KINDS.items()}
        ids, sizes = got["group"]
        keys, df, owner = got["shared"]
        # Ascending shingles are the order in which the group keeps the places of their sets.
        several = np.argsort(got["totals"][0])
        counted, total, n = (column[several] for column in got["totals"])
        keys, df = np.concatenate([keys, np.repeat(counted, n)]), np.concatenate([df, np.repeat(total, n)])
        owner = np.concatenate([owner, *got["own"]])
        order = np.lexsort((keys, df, owner))
        keys, owner = keys[order].view(np.int64), owner[order]
        cuts = np.append(np.flatnonzero(np.diff(owner.astype(np.int32), prepend=-1)), len(owner)).tolist()
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = int(sizes[owner[a]])
            prefix = n - _needed(n, num, den) + 1 - (n - (b - a))
            if prefix > 0:
                out.append((ids[owner[a]], n, keys[a:b], prefix))
        return pd.DataFrame(out, columns=["set_id", "n", "keys", "prefix"])

    return frequent.groupBy("grp").applyInPandas(finish, fields).dropDuplicates(["set_id"])


def search(sets: list[np.ndarray], n: np.ndarray, side: np.ndarray | None, num: int, den: int):
    """All linked pairs of sets, as positions. ``n`` is ascending; with sides given only pairs across them."""
    m = len(sets)
    lengths = np.array([len(s) for s in sets])
    names, key = np.unique(np.concatenate(sets), return_inverse=True)
    lists = np.sort(key.astype(np.int64) * m + np.repeat(np.arange(m), lengths))
    cuts = np.concatenate([[0], np.cumsum(lengths)])
    for q in range(m):
        low = int(np.searchsorted(n, _needed(int(n[q]), num, den)))
        mine = key[cuts[q] : cuts[q + 1]].astype(np.int64) * m
        left, right = np.searchsorted(lists, mine + low), np.searchsorted(lists, mine + q)
        size = right - left
        some = np.flatnonzero(size)
        need = -(-num * int(n[q] + n[low]) // (num + den))
        if len(some) < need:
            continue
        some = some[np.argsort(size[some], kind="stable")]
        long = min(need - 1, int(need / (PROBE * math.log2(size[some[-1]] + 1) + 1)))
        short, probed = some[: len(some) - long], some[len(some) - long :]
        # Each list is in order: a stable sort merges such runs. How long a run of equal places is, so many lists have it.
        merged = np.sort(np.concatenate([lists[left[i] : right[i]] - mine[i] for i in short.tolist()]), kind="stable")
        starts = np.flatnonzero(np.diff(merged, prepend=-1))
        found = np.diff(np.append(starts, len(merged)))
        who, found = merged[starts[found >= need - long]], found[found >= need - long]
        for rest, i in zip(range(long - 1, -1, -1), probed.tolist()):
            if not len(who):
                break
            where = lists[left[i] : right[i]]
            at = np.searchsorted(where, who + mine[i])
            found = found + (where[np.minimum(at, len(where) - 1)] == who + mine[i])
            keep = found >= need - rest
            who, found = who[keep], found[keep]
        linked = den * found >= num * (n[q] + n[who] - found)
        if side is not None:
            linked &= side[who] != side[q]
        yield q, who[linked]


def _search(bucketed: DataFrame, num: int, den: int) -> DataFrame:
    """(set_id, root, links): each set with a link, the smallest set reachable in this task, its partners' rows."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "set_id"], ignore_index=True)
        ids, weight = pdf["set_id"].to_numpy(), pdf["weight"].to_numpy()
        parent, total = list(range(len(ids))), np.zeros(len(ids), np.int64)

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        side = None if pdf["i"].iloc[0] == pdf["j"].iloc[0] else pdf["block"].to_numpy()
        for q, who in search(pdf["keys"].tolist(), pdf["n"].to_numpy().astype(np.int64), side, num, den):
            total[q] += weight[who].sum()
            total[who] += weight[q]
            for w in who.tolist():
                a, b = root(q), root(w)
                parent[max(a, b)] = min(a, b)
        has = np.flatnonzero(total)
        return pd.DataFrame({"set_id": ids[has], "root": [ids[root(x)] for x in has.tolist()], "links": total[has]})

    # Dealt by all three: blocks of one bucket go to different tasks.
    dealt = bucketed.repartition("bucket", "i", "j")
    return dealt.groupBy("bucket", "i", "j").applyInPandas(links, "set_id long, root long, links long")


def jaccard_groups(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Link documents whose sets of ``words``-word shingles have a Jaccard similarity of ``num / den`` or more.

    Returns per row of ``docs`` (``doc_id``, ``text``; other columns are not read) doc_id, n_shingles, component_id
    (the smallest doc_id reachable by links) and n_links (other rows linked directly, equal sets among them). A null or
    wordless text has an empty set and no link. A text with fewer words is one shingle. Rows with one doc_id are judged
    each by its own text; a null doc_id takes part in links but is never a component_id. An empty table gives no rows.
    """
    return _groups(docs, words, num, den).select("doc_id", "n_shingles", "component_id", "n_links")


def _groups(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``jaccard_groups`` with each row's set_id and its group's root, both null where there is no word."""
    spark = ship(docs.sparkSession)
    sets = saved(shingle_table(docs, words), "shingle-sets")
    ranges = max(1, math.ceil((sets.agg(F.sum("n_shingles")).first()[0] or 0) / RANGE_SIZE))
    classes = sets.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count("*").alias("weight"))
    classes = saved(classes, "shingle-classes")

    live = saved(_live(_frequent(_postings(docs, words, ranges)), num, den), "shingle-live")
    looked_up = live.select("set_id", F.explode(F.slice("keys", 1, F.col("prefix"))).alias("key"))
    lists = looked_up.groupBy("key").agg(F.min("set_id").alias("b"), F.count("*").alias("n")).where("n > 1")
    bucket = components(looked_up.join(lists, "key").select(F.col("set_id").alias("a"), "b"))

    placed = live.drop("prefix").join(bucket.withColumnsRenamed({"vertex": "set_id", "root": "bucket"}), "set_id")
    placed = saved(placed.join(classes.select("set_id", "weight"), "set_id"), "shingle-buckets")
    full = F.greatest(F.sum(F.size("keys")) / BLOCK_SIZE, F.count("*") / BLOCK_SETS)
    blocks = placed.groupBy("bucket").agg(F.ceil(full).cast("int").alias("blocks"))
    placed = placed.join(blocks, "bucket")
    # Buckets of one block are searched together: sets of different buckets have no link, so that finds no other pairs.
    together = max(1, math.ceil(placed.where("blocks = 1").count() / BLOCK_SETS))
    few = F.pmod(F.xxhash64("bucket"), F.lit(together))
    placed = placed.withColumns({"bucket": F.when(F.col("blocks") == 1, few).otherwise(F.col("bucket")), "block": F.pmod(F.hash("set_id"), "blocks")})
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    found = saved(_search(placed, num, den), "shingle-links")

    root = found.select("set_id", "root")
    if not placed.where("blocks > 1").isEmpty():  # otherwise each bucket was searched whole, and its roots are those of its groups
        root = components(root.select(F.col("set_id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("vertex", "set_id")
    links = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    classes = classes.join(root, "set_id", "left").join(links, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    classes = saved(classes, "shingle-roots")
    groups = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(groups, "root").select(
        "set_id", "root", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return sets.join(classes, "set_id", "left").select(
        "doc_id",
        "set_id",
        "root",
        "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


#: So many doc_ids are sent to all tasks; beyond that the join is a shuffle.
MOST_IDS = 4_000_000


def keep_one_of_each(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group in ``jaccard_groups``, with all columns.

    Each text is judged for itself: a row goes only if a row with a smaller doc_id is in its own text's group. Of rows that share
    doc_id and text one stays, and of rows of one doc_id in one group that with the smallest text. Rows without a doc_id stay.
    """
    groups = saved(_groups(docs.select("doc_id", "text"), words, num, den), "near-duplicates").where("doc_id is not null")
    gone = groups.where("doc_id != component_id").select("doc_id").distinct()
    again = groups.groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = saved(again, "repeated-ids")
    # Ids that stand once go by id alone.
    gone = gone.join(again, "doc_id", "left_anti")
    few = gone.limit(MOST_IDS + 1).count() <= MOST_IDS
    kept = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    if again.isEmpty():
        return kept
    def set_ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            sets = (keys for texts in chunks(part) for keys in shingle_sets(texts, words))
            yield pa.array([_set_id(keys) if len(keys) else None for keys in sets], pa.int64())

    several = docs.join(again, "doc_id", "left_semi").withColumn("_llm_set", F.arrow_udf(set_ids, "long")(F.col("text")))
    own = groups.join(again, "doc_id", "left_semi").where("doc_id = component_id")
    own = own.select(F.col("doc_id").alias("_llm_id"), F.col("set_id").alias("_llm_of"), F.col("root").alias("_llm_root")).distinct()
    several = several.join(own, (F.col("doc_id") == F.col("_llm_id")) & F.col("_llm_set").eqNullSafe(F.col("_llm_of")))
    rank = F.row_number().over(Window.partitionBy("doc_id", "_llm_root").orderBy(F.col("text").asc_nulls_last()))
    one = several.withColumn("_llm_rank", rank).where("_llm_rank = 1")
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(one.select(*docs.columns))
