"""The Merkle manifest against one made in plain Python, its persistent versions, and edge cases."""

from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from oracle_check import compare, duck
from pyspark.sql import functions as F

from weirflow.llm import merkle
from weirflow.llm.oracle import ORACLE
from weirflow.llm.queries import op13_merkle_dataset_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def changed(row):
    text = row["text"]
    if row["doc_id"] is None or text is None or crc32(str(row["doc_id"]).encode()) % 2:
        return text
    return text.replace("\n", "")


def tree(nodes):
    made = [nodes]
    while len(made[-1]) > 1:
        made.append([digest("".join(made[-1][i : i + 3])) for i in range(0, len(made[-1]), 3)])
    return made


def way(made, i):
    for level in made[:-1]:
        first = i - i % 3
        yield "".join(level[first:i]), "".join(level[i + 1 : first + 3])
        i //= 3


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        first = leaf(r, r["text"])
        by[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, first, r["doc_id"], leaf(r, changed(r))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s])]) for s in sources}
    top, out = tree([trees[s][-1][0] for s in sources]), []
    for k, s in enumerate(sources):
        for i, (_, _, first, doc_id, now) in enumerate(sorted(by[s])):
            ways = [*way(trees[s], i), *way(top, k)]
            for a, b in ways:
                now = digest(a + now + b)
            out.append((doc_id, first, trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in ways)), now, now == top[-1][0]))
    return out, trees, top


def plain(row):
    return tuple(map(str, row))


@pytest.fixture(scope="module")
def rows():
    sources = ["hot"] * 800 + [f"s{i % 17}" for i in range(60)] + ["é", "", None, None, "zz"]
    made = [(i * 7 % 1009, f"line {i}\nand\n{i % 5}" if i % 4 else None, "en" if i % 3 else None, s, i) for i, s in enumerate(sources)]
    made += [made[5], made[5], (None, "no id\n", "en", "hot", None), (None, None, None, None, None), (-4, "x\n" * 200_000, "en", "hot", 1), (3, "", "", "hot", 0)]
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in made]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)


def test_against_plain_python(docs, rows):
    clashing = docs.select("*", *[F.lit("clash").alias(c) for c in "tree place total digest block way now leaf root of n g p".split()])
    got = sorted(map(plain, merkle.verify(clashing).collect()))
    assert got == sorted(map(plain, brute(rows)[0]))


def test_versions_share_all_but_their_ancestors(docs, rows):
    manifest = merkle.build(docs, merkle.without_line_feeds())
    _, trees, top = brute(rows)
    want = {("-" if s is None else f"={s}", level, i): d for s, made in trees.items() for level, nodes in enumerate(made) for i, d in enumerate(nodes)}
    want |= {(merkle.TOP, level, i): d for level, nodes in enumerate(top) for i, d in enumerate(nodes)}
    found = merkle.tree_nodes(manifest).collect()
    assert len(found) == len(want) and {(r["tree"], r["level"], r["place"]): r["digest"] for r in found} == want
    names = {"-" if s is None else f"={s}": s for s in trees}
    for r in merkle.proven(manifest).collect():
        if r["now"] is None:
            assert r["copies"] is None and r["folded_root"] == r["root"]
            continue
        made, at = trees[names[r["tree"]]], r["place"]
        nodes = [list(level) for level in made]
        nodes[0][at] = r["now"]
        assert r["copies"][: len(made)] == [level[at // 3**i] for i, level in enumerate(tree(nodes[0]))]
        assert r["copies"][-1] == r["folded_root"] != r["root"] and r["copies"][0] == r["now"]


def test_few_rows(spark, docs):
    assert merkle.verify(docs.limit(0)).count() == 0
    one = merkle.verify(spark.createDataFrame([(9, "a\nb", "en", "s", 3)], SCHEMA)).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == digest("")


def test_against_sql(spark):
    root = "/root/testdata/sf0.001"
    con = duck(root)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{root}/documents.parquet')")
    name = "op13_merkle_dataset_manifest"
    assert compare(op13_merkle_dataset_manifest(spark, root), con, ORACLE[name]) is None
