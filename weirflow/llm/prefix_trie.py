"""The trie of conversation prefixes, with totals of every subtree by parallel tree contraction.

1. ``numbered`` gives each turn its place in its conversation, so a conversation of any length is spread over tasks.
2. ``prefixes``: a turn is a digest of its place, role and text, and a prefix the exclusive or of its turns' digests (120 bits of SHA-256).
   That adds up like a sum: within blocks of turns first, then over the blocks, never along a whole conversation in one task.
3. ``trie``: conversations with equal prefixes are one node, known by its smallest conversation and its depth.
4. ``contract``: rounds of joins. *Rake*: a node without children is done, and its parent takes over its totals. *Compress*: of a chain of
   nodes with one child each, those whose coin is 1 below a parent whose coin is 0 are taken out: their totals go to the parent, their child
   is linked to it. The coins of round r are bit r of the depth, which halves whole chains, and then hashes. So the rounds
   grow with the logarithm of the nodes, not with the depth.
5. ``expand``, backwards: a node taken out has what it held then and the total of its child.

Every round is written to the shared folder; a round that is run again gives the same rows.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import batch, saved, ship
from weirflow.llm.places import numbered

#: Turns of a conversation in one block; conversations of which one row of the digest of ends holds the ids.
BLOCK, IDS = 1024, 8192
#: A conversation is rebuilt on up to MOST - 1 turns of the first of its GROUP.
GROUP, MOST = 100, 6


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, total, mark, chars) per turn: its place among the conversation's turns and their number, a digest of role and text.

    Null turns stand first; turns of one number stand by role, then by ``mark``. Null role or text counts as empty; rows without a conv_id
    belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id is not null")
    turns = turns.select("conv_id", "turn", role.alias("role"), F.unhex(mark).alias("mark"), F.length(text).cast("long").alias("chars"))
    return numbered(turns, "conv_id", ["turn", "role", "mark"]).drop("turn", "role")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, length) and turns (conv_id, place, mark, chars, last) after each has got its head.

    Conversation c takes the first h turns of conversation c - c % GROUP, h being its CRC-32 modulo MOST, and then its own after its first h.
    """
    heads = F.crc32(F.col("conv_id").cast("string")) % MOST
    own = turns.where("place = 0").select("conv_id", F.col("total").alias("n"), heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    given = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = own.join(given, "base", "left").withColumn("nb", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("length", F.col("nb") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = saved(convs.select("conv_id", "n", "h", "base", "nb", "length"), "trie-conversations")
    last = (F.col("place") == F.col("length") - 1).alias("last")

    first = turns.where(F.col("place") < MOST - 1).select(F.col("conv_id").alias("base"), "place", "mark", "chars")
    from_base = convs.join(first, "base").where("place < h").select("conv_id", "place", "mark", "chars", last)
    # A long conversation meets its row once per block, so no key has more than BLOCK turns.
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK)))
    spread = convs.where("n > h").select("conv_id", "h", "nb", "length", block.alias("block"))
    rest = turns.withColumn("block", F.floor(F.col("place") / BLOCK)).join(spread, ["conv_id", "block"]).where("place >= h")
    rest = rest.withColumn("place", F.col("place") - F.col("h") + F.col("nb")).select("conv_id", "place", "mark", "chars", last)
    return convs.select("conv_id", "length"), from_base.unionByName(rest)


def _bits(digest: Column, first: int) -> Column:
    """60 bits of a digest in hex."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, chars, last) of each prefix that ends with a turn; (a, b) names it, (up_a, up_b) that without its last turn."""
    digest = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.hex("mark")), 256)
    turns = turns.withColumn("digest", digest).withColumns({"own_a": _bits(F.col("digest"), 1), "own_b": _bits(F.col("digest"), 16)})
    turns = saved(turns.drop("digest", "mark").withColumn("block", F.floor(F.col("place") / BLOCK)), "trie-turns")
    blocks = turns.groupBy("conv_id", "block").agg(F.bit_xor("own_a").alias("a"), F.bit_xor("own_b").alias("b"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = {f"before_{x}": F.coalesce(F.bit_xor(x).over(before), F.lit(0)) for x in "ab"}
    blocks = blocks.withColumns(so_far).drop("a", "b")
    within = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumns({x: F.bit_xor(f"own_{x}").over(within) for x in "ab"}).join(blocks, ["conv_id", "block"])
    turns = turns.withColumns({x: F.col(x).bitwiseXOR(F.col(f"before_{x}")) for x in "ab"})
    up = [F.col(x).bitwiseXOR(F.col(f"own_{x}")).alias(f"up_{x}") for x in "ab"]
    return turns.select("conv_id", (F.col("place") + 1).alias("depth"), "a", "b", *up, "chars", "last")


def digest_of_ends(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes where conversations end, from (depth, a, b, conv_id).

    Ids are joined by ranges of IDS first; a node's ranges then pass one task in order, as a stream, of which no more than a batch is held.
    """
    ship(ends.sparkSession)
    key = ["depth", "a", "b"]
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    ends = ends.withColumn("range", F.floor(F.col("conv_id") / IDS)).groupBy(*key, "range").agg(ids.alias("ids"))
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])

    def hashed(batches):
        node, state = None, None
        for part in batches:
            done = []
            for *of, text in zip(*(part.column(c).to_pylist() for c in (*key, "ids"))):
                if of != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = of, sha256(text.encode())
                else:
                    state.update(("," + text).encode())
            if done:
                yield batch(schema, *zip(*done))
        if node is not None:
            yield batch(schema, *zip((*node, state.hexdigest())))

    in_order = ends.repartition(*key).sortWithinPartitions(*key, "range").select(*key, "ids")
    return in_order.mapInArrow(hashed, "depth long, a long, b long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes: conv_id (their smallest member), depth, parent_conv_id, n_convs, chars of the last text and ends_sha256."""
    convs, turns = rebuilt(turns_in_order(conversations))
    below = saved(prefixes(turns), "trie-prefixes")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b", "up_a", "up_b", "chars")]
    members = below.unionByName(convs.select("conv_id", *zero, (F.col("length") == 0).alias("last")))
    nodes = members.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b")
    )
    nodes = saved(nodes, "trie-nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    ends = digest_of_ends(members.where("last").select("depth", "a", "b", "conv_id"))
    # Nodes meet their parent in a join that Spark may split where a parent has very many children.
    nodes = nodes.join(parents, ["depth", "up_a", "up_b"], "left").join(ends, ["depth", "a", "b"], "left")
    none = F.lit(sha256(b"").hexdigest())
    nodes = nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "chars", F.coalesce("ends_sha256", none).alias("ends_sha256"))
    return saved(nodes, "trie-linked")


def _coin(conv: str, depth: str, turn: int, bits: int) -> Column:
    """0 or 1 per node and round."""
    if turn < bits:
        return F.shiftright(depth, turn).bitwiseAND(1)
    return F.xxhash64(conv, depth, F.lit(turn)).bitwiseAND(1)


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(conv_id, depth, *values): each node's ``values`` summed over its subtree, itself included.

    ``nodes`` has conv_id, depth, parent_conv_id (null for a root) and the values, whole numbers.
    """
    one_up = F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1)
    active = nodes.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"), one_up.alias("pd"), *values)
    bits = int(active.agg(F.max("d")).first()[0] or 0).bit_length()
    rounds = []
    while True:
        flagged, kept, active = _contract(active, values, len(rounds), bits)
        rounds.append((flagged, kept))
        if active.limit(1).count() == 0:
            break
    return _expand(rounds, values).select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), *values)


def _contract(active: DataFrame, values: list[str], turn: int, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: nodes with ``leaf``, those that are none with ``cut``, and what is left of them."""
    children = active.where("pc is not null")
    kids = children.groupBy("pc", "pd").agg(F.count("*").alias("kids")).withColumnsRenamed({"pc": "c", "pd": "d"})
    flagged = active.join(kids, ["c", "d"], "left").withColumn("leaf", F.col("kids").isNull()).drop("kids")
    flagged = saved(flagged, "trie-rake")
    # Rake: leaves hand their totals up. What of the children is left tells whether the parent is part of a chain.
    raked = flagged.where("pc is not null").groupBy("pc", "pd").agg(
        *[F.coalesce(F.sum(F.when(F.col("leaf"), F.col(v))), F.lit(0)).alias(f"raked_{v}") for v in values],
        F.count_if(~F.col("leaf")).alias("rest"),
        F.min(F.when(~F.col("leaf"), F.struct(F.col("c"), F.col("d")))).alias("child"),
    )
    raked = raked.withColumnsRenamed({"pc": "c", "pd": "d"})
    kept = flagged.where("not leaf").drop("leaf").join(raked, ["c", "d"])
    kept = kept.withColumns({v: F.col(v) + F.col(f"raked_{v}") for v in values}).drop(*[f"raked_{v}" for v in values])
    chain = (F.col("rest") == 1) & F.col("pc").isNotNull() & (_coin("c", "d", turn, bits) == 1) & (_coin("pc", "pd", turn, bits) == 0)
    kept = saved(kept.withColumn("cut", F.coalesce(chain, F.lit(False))), "trie-compress")
    # Compress: no node is cut together with its parent, so each is taken out for itself.
    cut = kept.where("cut")
    up = cut.groupBy("pc", "pd").agg(*[F.sum(v).alias(f"cut_{v}") for v in values]).withColumnsRenamed({"pc": "c", "pd": "d"})
    link = cut.select(F.col("child.c").alias("c"), F.col("child.d").alias("d"), F.col("pc").alias("new_c"), F.col("pd").alias("new_d"))
    left = kept.where("not cut").join(up, ["c", "d"], "left").join(link, ["c", "d"], "left")
    sums = {v: F.col(v) + F.coalesce(f"cut_{v}", F.lit(0)) for v in values}
    left = left.withColumns({**sums, "pc": F.coalesce("new_c", "pc"), "pd": F.coalesce("new_d", "pd")})
    return flagged, kept, saved(left.select("c", "d", "pc", "pd", *values), "trie-active")


def _expand(rounds: list[tuple[DataFrame, DataFrame]], values: list[str]) -> DataFrame:
    """Totals of all nodes, from the last round to the first."""
    known: list[DataFrame] = []
    for flagged, kept in reversed(rounds):
        if known:
            cut = kept.where("cut").select("c", "d", "child", *values)
            later = reduce(DataFrame.unionByName, known)
            below = later.select(F.struct("c", "d").alias("child"), *[F.col(v).alias(f"below_{v}") for v in values])
            total = [(F.col(v) + F.col(f"below_{v}")).alias(v) for v in values]
            known.append(saved(cut.join(below, "child").select("c", "d", *total), "trie-expand"))
        known.append(flagged.where("leaf").select("c", "d", *values))
    return reduce(DataFrame.unionByName, known)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (conv_id, turn, role, text; other columns are not read).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (code points that sharing saves in the subtree) and ends_sha256,
    as the functions above make them. Null turns stand first, null roles and texts are empty, rows without a conv_id are left out, repeated rows
    are turns of their own, texts are hashed whole, and an empty table gives no rows.
    """
    nodes = trie(conversations)
    kids = nodes.where("parent_conv_id is not null").groupBy("parent_conv_id", (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    kids = kids.withColumnRenamed("parent_conv_id", "conv_id")
    nodes = nodes.join(kids, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = saved(nodes, "trie-counted")
    own = {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")}
    totals = subtree_totals(nodes.withColumns(own), list(own))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return nodes.join(totals, ["conv_id", "depth"]).select(*columns)
