"""The trie of conversation prefixes against one made in plain Python, tree contraction on shapes of trees, and edge cases."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from oracle_check import compare, duck
from pyspark.sql import functions as F

from weirflow.llm.oracle import ORACLE
from weirflow.llm.prefix_trie import digest_of_ends, prefix_trie, subtree_totals
from weirflow.llm.queries import op12_conversation_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Rows as of ``prefix_trie``; turns that share a number must not differ in the test data but for their role."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, ts in turns.items():
        h = crc32(str(c).encode()) % 6
        made[c] = turns.get(c - c % 100, [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, tokens = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            tokens[node[:d]] += (len(inside) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, inside in members.items():
        up = min(members[node[:-1]]) if node else None
        digest = sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(inside), len(node), up, len(inside), kids[node], leaves[node], tokens[node], digest))
    return out


def plain(row):
    return tuple(map(str, row))


def test_against_plain_python(spark):
    pick = random.Random(5)
    words = ["hi", "yes", "é🎉", "", None, "long " * 9]
    rows = [(c, t, pick.choice(["user", "assistant"]), pick.choice(words)) for c in range(95, 330) for t in range(pick.randint(1, 9))]
    rows += [(100 * k, t, "user", "same") for k in (5, 6) for t in range(8)] + [(500 + i, t, "user", "same") for i in range(1, 60) for t in range(8)]
    rows += [(412, 1, "user", "base is absent"), (7, None, "user", "no turn"), (7, 3, None, None), (7, None, "user", "no turn"), (None, 1, "user", "nobody")]
    rows += [(700, t, "user", f"turn {t}") for t in range(40)] + [(733, t, "user", f"other {t % 3}") for t in range(30)]
    table = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("clash").alias(c) for c in "place total mark chars n h base block depth a b c d leaf cut child".split()])
    got = sorted(map(plain, prefix_trie(table).collect()))
    assert got == sorted(map(plain, brute(rows)))


def test_a_conversation_of_several_blocks(spark):
    rows = [(c, t, "user", "x" if t < 1100 else f"{c}") for c in (800, 801) for t in range(1100 + 30)]
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 1 + 1100 + 2 * 30
    assert got[800, 0]["n_leaves"] == 2 and got[800, 0]["saved_tokens"] == 1100 and got[800, 1100]["saved_tokens"] == 1 and got[801, 1130]["n_convs"] == 1


@pytest.mark.parametrize("shape", ["chain", "random", "comb"])
def test_subtree_totals(spark, shape):
    pick, n = random.Random(3), 60
    up = {"chain": lambda i: i - 1, "random": lambda i: pick.randrange(i), "comb": lambda i: i - 1 if i % 2 else max(0, i - 2)}[shape]
    parent = [None] + [up(i) for i in range(1, n)]
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    total = list(range(n))
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    nodes = spark.createDataFrame([(i, depth[i], parent[i], i) for i in range(n)], "conv_id long, depth long, parent_conv_id long, v long")
    assert {r["conv_id"]: r["v"] for r in subtree_totals(nodes, ["v"]).collect()} == dict(enumerate(total))


def test_ends_over_several_ranges(spark):
    ids = list(range(-9000, 30_000, 3))
    got = digest_of_ends(spark.createDataFrame([(1, 2, 3, i) for i in ids] + [(1, 2, 4, 5)], "depth long, a long, b long, conv_id long")).collect()
    want = {3: sha256(",".join(map(str, ids)).encode()).hexdigest(), 4: sha256(b"5").hexdigest()}
    assert {r["b"]: r["ends_sha256"] for r in got} == want


def test_empty(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_against_sql(spark):
    root = "/root/testdata/sf0.001"
    con = duck(root)
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{root}/conversations.parquet')")
    assert compare(op12_conversation_prefix_trie(spark, root), con, ORACLE["op12_conversation_prefix_trie"]) is None
